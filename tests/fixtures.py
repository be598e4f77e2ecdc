"""Hand-made raw batches (CSV folders) covering the cases of FIXTURES.md."""

from __future__ import annotations

import csv
import os

from strata.sources.specs import SOURCES


def write_csv(folder: str, source: str, rows: list[dict], bom: bool = False, header: list[str] | None = None) -> str:
    os.makedirs(folder, exist_ok=True)
    spec = SOURCES[source]
    path = os.path.join(folder, spec.file)
    cols = header or list(spec.columns)
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as fh:
        w = csv.DictWriter(fh, fieldnames=cols, quoting=csv.QUOTE_MINIMAL)
        w.writeheader()
        for r in rows:
            w.writerow({c: r.get(c, "") for c in cols})
    return path


def product(pid, cat, weight, photos="1", length="10", height="10", width="10"):
    return {
        "product_id": pid,
        "product_category_name": cat,
        "product_name_lenght": "20",
        "product_description_lenght": "100",
        "product_photos_qty": photos,
        "product_weight_g": weight,
        "product_length_cm": length,
        "product_height_cm": height,
        "product_width_cm": width,
    }


def order(oid, cid, purchase, status="delivered", approved="", delivered="", estimated=""):
    return {
        "order_id": oid,
        "customer_id": cid,
        "order_status": status,
        "order_purchase_timestamp": purchase,
        "order_approved_at": approved,
        "order_delivered_carrier_date": "",
        "order_delivered_customer_date": delivered,
        "order_estimated_delivery_date": estimated,
    }


def item(oid, n, pid, price, freight="5.00", seller="s1", limit="2017-01-10 00:00:00"):
    return {
        "order_id": oid,
        "order_item_id": n,
        "product_id": pid,
        "seller_id": seller,
        "shipping_limit_date": limit,
        "price": price,
        "freight_value": freight,
    }


def batch_1(root: str) -> str:
    """2017-01: reference data and the first orders."""
    d = os.path.join(root, "2017-01")
    write_csv(
        d,
        "category_translation",
        [
            {"product_category_name": "beleza_saude", "product_category_name_english": "health_beauty"},
            {"product_category_name": "automotivo", "product_category_name_english": "auto"},
        ],
        bom=True,
    )
    write_csv(
        d,
        "customers",
        [
            {"customer_id": "c1", "customer_unique_id": "u1", "customer_zip_code_prefix": "1310",
             "customer_city": " sao PAULO ", "customer_state": "sp"},
            {"customer_id": "c2", "customer_unique_id": "u1", "customer_zip_code_prefix": "123456",
             "customer_city": "rio de janeiro", "customer_state": "rj"},
            {"customer_id": "c3", "customer_unique_id": "u2", "customer_zip_code_prefix": "20000",
             "customer_city": "niteroi", "customer_state": "rj"},
            {"customer_id": "c4", "customer_unique_id": "", "customer_zip_code_prefix": "1",
             "customer_city": "x", "customer_state": "x"},
        ],
    )
    write_csv(
        d,
        "sellers",
        [{"seller_id": "s1", "seller_zip_code_prefix": "1310", "seller_city": "sao paulo", "seller_state": "SP"}],
    )
    write_csv(
        d,
        "geolocation",
        [
            {"geolocation_zip_code_prefix": "1310", "geolocation_lat": "-23.5", "geolocation_lng": "-46.6"},
            {"geolocation_zip_code_prefix": "1310", "geolocation_lat": "-23.7", "geolocation_lng": "-46.8"},
            {"geolocation_zip_code_prefix": "01310", "geolocation_lat": "-23.6", "geolocation_lng": "-46.7"},
            {"geolocation_zip_code_prefix": "1310", "geolocation_lat": "45", "geolocation_lng": "-46.6"},
            {"geolocation_zip_code_prefix": "1310", "geolocation_lat": "", "geolocation_lng": "-46.6"},
            {"geolocation_zip_code_prefix": "1310", "geolocation_lat": "abc", "geolocation_lng": "-46.6"},
        ],
    )
    write_csv(
        d,
        "products",
        [
            product("p1", "beleza_saude", "500"),
            product("p2", "sem_traducao", "225.0"),
            product("p3", "", "abc"),
            product("p4", "automotivo", "-5"),
            product("p5", "automotivo", ""),
        ],
    )
    write_csv(
        d,
        "orders",
        [
            order("o1", "c1", "2017-01-05 10:00:00", approved="2017-01-05 11:00:00",
                  delivered="2017-01-12 10:00:00", estimated="2017-01-12 00:00:00"),
            order("o2", "c2", "2017-01-20 09:00:00", approved="bad", delivered="2017-01-25 09:00:00",
                  estimated="2017-01-30 00:00:00"),
            order("o3", "c3", "2017-01-21 09:00:00", status=" SHIPPED "),
            order("o4", "c3", "not a date"),
        ],
    )
    write_csv(
        d,
        "order_items",
        [
            item("o1", "1", "p1", "10.00"),
            item("o1", "1", "p1", "11.00", limit="2017-01-11 00:00:00"),
            item("o1", "2", "p2", "1.005"),
            item("o2", "1", "p1", "-1"),
            item("o2", "2", "p2", "abc"),
            item("o3", "1", "p9", "20.00"),
            item("o9", "1", "p1", "30.00"),
        ],
    )
    write_csv(
        d,
        "order_payments",
        [
            {"order_id": "o1", "payment_sequential": "1", "payment_type": " Credit_Card",
             "payment_installments": "3", "payment_value": "16.00"},
            {"order_id": "o1", "payment_sequential": "2", "payment_type": "voucher",
             "payment_installments": "1", "payment_value": "5.00"},
            {"order_id": "o9", "payment_sequential": "1", "payment_type": "boleto",
             "payment_installments": "1", "payment_value": "30.00"},
        ],
    )
    write_csv(
        d,
        "order_reviews",
        [
            {"review_id": "r1", "order_id": "o1", "review_score": "5", "review_comment_title": "",
             "review_comment_message": 'bom,\nmuito "bom"', "review_creation_date": "2017-01-13 00:00:00",
             "review_answer_timestamp": "2017-01-14 12:30:45"},
            {"review_id": "r1", "order_id": "o2", "review_score": "4", "review_comment_title": "",
             "review_comment_message": "", "review_creation_date": "2017-01-26 00:00:00",
             "review_answer_timestamp": "2017-01-26 06:00:00"},
            {"review_id": "r2", "order_id": "o3", "review_score": "0", "review_comment_title": "",
             "review_comment_message": "", "review_creation_date": "2017-01-26 00:00:00",
             "review_answer_timestamp": ""},
            {"review_id": "r3", "order_id": "o3", "review_score": "6", "review_comment_title": "",
             "review_comment_message": "", "review_creation_date": "2017-01-26 00:00:00",
             "review_answer_timestamp": ""},
        ],
    )
    return d


def batch_2(root: str, corrected: bool = False) -> str:
    """2017-02: product changes and orders on both sides of them."""
    d = os.path.join(root, "2017-02")
    write_csv(
        d,
        "products",
        [
            product("p1", "beleza_saude", "600" if not corrected else "650"),  # tracked change
            product("p2", "sem_traducao", "225", photos="7"),  # untracked only
            product("p5", "automotivo", ""),  # unchanged
            product("p6", "automotivo", "100"),  # new
        ],
    )
    write_csv(
        d,
        "orders",
        [
            order("o5", "c1", "2017-01-31 23:59:59"),
            order("o6", "c1", "2017-02-01 00:00:00"),
            order("o7", "c3", "2017-02-15 00:00:00", delivered="2017-02-20 00:00:00", estimated="2017-02-25 00:00:00"),
            order("o11", "c2", "2017-02-20 00:00:00"),  # makes c2 u1's latest record until c2 moves
        ],
    )
    write_csv(
        d,
        "order_items",
        [item("o5", "1", "p1", "10.00"), item("o6", "1", "p1", "10.00"), item("o7", "1", "p1", "10.00"),
         item("o7", "2", "p8", "3.00")],
    )
    write_csv(d, "order_payments", [])
    return d


def batch_3(root: str) -> str:
    """2017-03: a translation fix, more points for a known zip, an order
    that moves to another day."""
    d = os.path.join(root, "2017-03")
    write_csv(
        d,
        "category_translation",
        [{"product_category_name": "sem_traducao", "product_category_name_english": "no_translation"}],
    )
    write_csv(
        d,
        "geolocation",
        [{"geolocation_zip_code_prefix": "1310", "geolocation_lat": "-23.8", "geolocation_lng": "-46.9"}],
    )
    write_csv(
        d,
        "orders",
        [order("o7", "c3", "2017-03-02 00:00:00", delivered="2017-03-05 00:00:00", estimated="2017-03-10 00:00:00"),
         order("o8", "c2", "2017-03-03 00:00:00")],
    )
    write_csv(d, "order_items", [item("o8", "1", "p2", "7.50")])
    write_csv(
        d,
        "customers",
        [{"customer_id": "c2", "customer_unique_id": "u3", "customer_zip_code_prefix": "123456",
          "customer_city": "rio de janeiro", "customer_state": "rj"}],
    )
    write_csv(
        d,
        "sellers",
        [{"seller_id": "s2", "seller_zip_code_prefix": "1310", "seller_city": "sao paulo", "seller_state": "SP"}],
    )
    return d
