"""Personal data by weak supervision.

Candidate spans come from strict patterns (the base: email, ip, card, phone)
and from looser ones. Labelers vote on every candidate:

* pattern: the strict rule holds (format, digit counts, Luhn sum);
* gazetteer: the top-level domain, issuer digit, calling code or first octet
  is a listed one;
* context: a cue word for the kind stands shortly before;
* edges: the span is not part of a longer word or number;
* no denial: no word that names another kind of number stands before.

Votes are counted per pattern over the whole table. Expectation-maximisation
over these counts (kinds x 2^5 rows at most) estimates each labeler's
reliability and each pattern's probability. These are the soft labels of the
final classifier, a naive Bayes model over the span's shape (kind, length,
share of digits, separators) and its votes. A loose candidate is reported if
the classifier gives it at least one half and it overlaps no base span; base
spans always stay.

All of it is DataFrame expressions. Spans are offsets in code points.

Defined cases: a null text is the empty text; each row is judged alone, so
repeated rows and doc_ids get equal results; without candidates there is no
added span; an empty table gives no rows; extra columns are ignored. Patterns
use possessive runs, so that long texts take linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
#: Strict patterns. \G lets a match start where the last one ended; elsewhere a run starts at its first character.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser patterns, whose matches need the classifier's consent.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{2,63}+(?:\x20?(?:\[dot\]|\(dot\)|\.)\x20?[A-Za-z0-9-]{2,63}+)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9-])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9-])",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
}
#: A cheap necessary condition of any match.
NEEDS = {"email": "@|\\[at\\]|\\(at\\)", "ip": "[0-9]\\.[0-9]|:[0-9a-fA-F]{1,4}:", "card": "[0-9][\\x20-]?[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]|[0-9]{3}[).-]"}
#: Gazetteers, by kind: what a labeler looks up.
DOMAINS = "com org net edu gov int info biz io dev app me co ai uk de fr es it nl be ch at pt pl se no dk fi ie cz gr eu us ca mx br ar cl jp cn kr in au nz za ru ua tr".split()
ISSUERS = "3 4 5 6".split()
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 380 420 421".split()
CUES = {
    "email": "mail|courriel|correo|contact|kontakt|contacto|@",
    "ip": "ip|host|server|serveur|servidor|address|adresse|login|client",
    "card": "card|carte|karte|tarjeta|visa|master|amex|credit|debit|pay",
    "phone": "phone|tel|call|mobile|cell|fax|appel|anruf|llam|whatsapp|sms",
}
DENIALS = "version|release|isbn|issn|order|invoice|ticket|serial|part|ratio|chapter|section"
WINDOW = 32
ROUNDS = 25
LABELERS = 5
SPAN = "struct<start:int,end:int,word:string>"


def _digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    one = lambda i: F.substr(digits, i, F.lit(1)).cast("int")
    twice = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + F.when((n - i) % 2 == 1, twice(one(i))).otherwise(one(i)))
    return total % 10 == 0


def _octets_hold(word: Column) -> Column:
    plain = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(word, r"\."), lambda p: (F.length(plain(p)) <= 3) & (F.substr(plain(p), F.lit(1), F.lit(3)).cast("int") <= 255))


def holds(kind: str, word: Column) -> Column:
    """The strict rule beyond the pattern."""
    n = F.length(_digits(word))
    if kind == "ip":
        return _octets_hold(word)
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(_digits(word))).otherwise(False)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, word>> of the leftmost matches, from the
    lengths of the matches and of the pieces between them."""
    step = 256  # prefix sums by blocks: n * (n / step + step) for n matches
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between"))

    def spans(x: Column) -> Column:
        lengths = F.zip_with(F.slice(x["between"], 1, F.size(x["found"])), x["found"], lambda a, b: F.length(a) + F.length(b))
        total = lambda ls: F.aggregate(ls, F.lit(0), lambda acc, n: acc + n)

        def place(ls: Column) -> Column:
            blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(ls) / step).cast("int")), lambda b: total(F.slice(ls, b * step + 1, step)))
            return F.transform(
                F.array(blocks),
                lambda bs: F.transform(
                    x["found"],
                    lambda word, i: F.struct(
                        (total(F.slice(bs, F.lit(1), F.floor(i / step).cast("int"))) + total(F.slice(ls, F.floor(i / step).cast("int") * step + 1, i % step)) + F.length(F.get(x["between"], i))).alias("start"),
                        word.alias("word"),
                    ),
                ),
            )[0]

        put = F.transform(F.array(lengths), place)[0]
        return F.transform(put, lambda s: F.struct(s["start"].alias("start"), (s["start"] + F.length(s["word"])).alias("end"), s["word"].alias("word")))

    return F.transform(F.array(both), lambda x: F.when(F.size(x["found"]) > 0, spans(x)).otherwise(F.expr(f"cast(array() as array<{SPAN}>)")))[0]


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(matches(text, STRICT[kind]), lambda s: holds(kind, s["word"]))


def _listed(kind: str, word: Column) -> Column:
    if kind == "email":
        return F.lower(F.regexp_extract(word, r"([A-Za-z]+)$", 1)).isin(*DOMAINS)
    if kind == "card":
        return F.substr(_digits(word), F.lit(1), F.lit(1)).isin(*ISSUERS)
    if kind == "phone":
        codes = "|".join(sorted(CALLING, key=lambda c: (-len(c), c)))
        return word.rlike(rf"^\+(?:{codes})[^0-9]?|^\([2-9]|^[2-9]")
    return F.regexp_extract(word, r"^0*([0-9]{1,3})\.", 1).try_cast("int").between(1, 223) | word.contains(":")


def candidate(kind: str, text: Column, span: Column, strict: bool) -> Column:
    """kind, span, the labelers' votes and the span's shape."""
    before = F.lower(F.substr(text, F.greatest(span["start"] - WINDOW, F.lit(0)) + 1, F.least(span["start"], F.lit(WINDOW))))
    word, after = span["word"], F.substr(text, span["end"] + 1, F.lit(1))
    digits = F.length(_digits(word))
    votes = [
        F.lit(strict) if strict else F.when(F.lit(kind == "card"), digits.between(13, 19) & _luhn(_digits(word))).otherwise(F.lit(False)),
        F.coalesce(_listed(kind, word), F.lit(False)),
        before.rlike(rf"(?:{CUES[kind]})[^\p{{L}}]*+\p{{L}}{{0,8}}+[^\p{{L}}]*+$"),
        ~(before.rlike(r"[\p{L}\p{N}]$") | after.rlike(r"[\p{L}\p{N}]")),
        ~before.rlike(rf"(?:{DENIALS})[^\p{{L}}]*+$"),
    ]
    shape = F.array(
        F.concat(F.lit(f"{kind}:length:"), F.least(F.floor(F.length(word) / 4), F.lit(10)).cast("string")),
        F.concat(F.lit(f"{kind}:digits:"), F.floor(4 * digits / F.length(word)).cast("string")),
        F.concat(F.lit(f"{kind}:marks:"), F.least(F.length(F.regexp_replace(word, "[A-Za-z0-9]", "")), F.lit(6)).cast("string")),
    )
    return F.struct(
        F.lit(kind).alias("kind"),
        F.lit(strict).alias("base"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        F.array(*[v.cast("int") for v in votes]).alias("votes"),
        shape.alias("shape"),
    )


def candidates(text: Column) -> Column:
    """All candidate spans of a text, by kind as listed, then start."""
    none = F.expr("cast(array() as array<struct<kind:string,base:boolean,start:int,end:int,votes:array<int>,shape:array<string>>>)")

    def of(kind: str):
        def both(bs: Column) -> Column:
            apart = lambda s: ~F.exists(bs, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
            strict = F.transform(bs, lambda s: candidate(kind, text, s, True))
            loose = F.transform(F.filter(matches(text, LOOSE[kind]), apart), lambda s: candidate(kind, text, s, False))
            return F.array_sort(F.concat(strict, loose), lambda a, b: a["start"] - b["start"])

        return F.transform(F.array(base_spans(text, kind)), both)[0]

    return F.concat(*[F.when(text.rlike(NEEDS[kind]), of(kind)).otherwise(none) for kind in KINDS])


def vote_patterns(docs: DataFrame) -> DataFrame:
    """kind, votes, shape, n: counts over the whole table (map-side combined)."""
    return docs.select(F.explode(candidates(text_or_empty())).alias("c")).groupBy("c.kind", "c.votes", "c.shape").agg(F.count(F.lit(1)).alias("n"))


def _likelihood(votes: Column, rates: Column) -> Column:
    return F.aggregate(F.zip_with(votes, rates, lambda v, r: F.when(v == 1, r).otherwise(1 - r)), F.lit(1.0), lambda acc, p: acc * p)


def reliabilities(patterns: DataFrame) -> DataFrame:
    """One row: prior, hit (P(vote | private)) and alarm (P(vote | not)) per
    labeler, after ROUNDS rounds of expectation-maximisation over the counts
    of vote patterns (kinds x 2^LABELERS entries at most)."""
    counts = patterns.groupBy("kind", "votes").agg(F.sum("n").alias("n")).groupBy().agg(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n"))).alias("p"))
    start = F.struct(
        F.lit(0.5).alias("prior"),
        F.array(*[F.lit(x) for x in (0.9, 0.8, 0.3, 0.9, 0.97)]).alias("hit"),
        F.array(*[F.lit(x) for x in (0.1, 0.4, 0.05, 0.5, 0.7)]).alias("alarm"),
    )

    def round_(state: Column, _: Column) -> Column:
        def share(x: Column) -> Column:
            yes, no = state["prior"] * _likelihood(x["votes"], state["hit"]), (1 - state["prior"]) * _likelihood(x["votes"], state["alarm"])
            return F.struct(x["votes"].alias("votes"), (x["n"] * yes / (yes + no)).alias("yes"), (x["n"] * no / (yes + no)).alias("no"))

        def estimate(parts: Column) -> Column:
            total = lambda name: F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x[name])
            fired = lambda name, i: F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x[name] * F.get(x["votes"], F.lit(i)))
            rate = lambda name, i: (fired(name, i) + 1) / (total(name) + 2)
            return F.struct(
                ((total("yes") + 1) / (total("yes") + total("no") + 2)).alias("prior"),
                F.array(*[rate("yes", i) for i in range(LABELERS)]).alias("hit"),
                F.array(*[rate("no", i) for i in range(LABELERS)]).alias("alarm"),
            )

        return F.transform(F.array(F.transform(F.col("p"), share)), estimate)[0]

    return counts.select(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_).alias("m")).select("m.*")


def classifier(spark: SparkSession, patterns: DataFrame) -> DataFrame:
    """One row: the log odds of the prior and of every feature (votes and
    shape values), from the soft labels; a few hundred features at most."""
    rates = written(spark, reliabilities(patterns), "pii-rates").first()  # eleven numbers
    hit, alarm = (F.array(*map(F.lit, rates[x])) for x in ("hit", "alarm"))
    yes, no = rates["prior"] * _likelihood(F.col("votes"), hit), (1 - rates["prior"]) * _likelihood(F.col("votes"), alarm)
    soft = patterns.withColumn("private", yes / (yes + no))
    by = soft.select(F.explode(features(F.col("votes"), F.col("shape"))).alias("feature"), "n", "private")
    odds = by.groupBy("feature").agg(F.sum(F.col("n") * F.col("private")).alias("yes"), F.sum(F.col("n") * (1 - F.col("private"))).alias("no"))
    every = soft.agg(F.sum(F.col("n") * F.col("private")).alias("all_yes"), F.sum(F.col("n") * (1 - F.col("private"))).alias("all_no")).first()
    a, b = (every["all_yes"] or 0.0) + 1, (every["all_no"] or 0.0) + 1  # two numbers
    weight = F.log((F.col("yes") + 0.5) / F.lit(a)) - F.log((F.col("no") + 0.5) / F.lit(b))
    entries = F.map_from_entries(F.collect_list(F.struct("feature", weight.alias("weight"))))
    return odds.groupBy().agg(entries.alias("weights")).withColumn("prior", F.log(F.lit(a / b)))


def features(votes: Column, shape: Column) -> Column:
    return F.concat(F.transform(votes, lambda v, i: F.concat_ws(":", F.lit("vote"), i.cast("string"), v.cast("string"))), shape)


def find(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id and its spans (kind, base, start, end, probability)."""
    patterns = written(spark, vote_patterns(docs), "pii-patterns")
    model = written(spark, classifier(spark, patterns), "pii-model").first()  # at most a few hundred weights
    weights = F.create_map(*[F.lit(x) for pair in (model["weights"] or {}).items() for x in pair]) if model and model["weights"] else F.expr("map('', 0D)")
    prior = F.lit(model["prior"] if model else 0.0)

    def judged(c: Column) -> Column:
        score = F.aggregate(features(c["votes"], c["shape"]), prior, lambda acc, f: acc + F.coalesce(F.try_element_at(weights, f), F.lit(0.0)))
        return F.struct(c["kind"].alias("kind"), c["base"].alias("base"), c["start"].alias("start"), c["end"].alias("end"), (1 / (1 + F.exp(-score))).alias("probability"))

    spans = F.filter(F.transform(candidates(text_or_empty()), judged), lambda s: s["base"] | (s["probability"] >= 0.5))
    return docs.select("doc_id", spans.alias("spans"))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = find(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))
