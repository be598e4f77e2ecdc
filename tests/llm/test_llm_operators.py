"""The operators' own interfaces."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import bpe, chat, fingerprint, graph, jaccard, language, lexical, mixing, pii, runs, secrets, sharding, tokenfile, topk


# ---- 1 ----------------------------------------------------------------------
def test_classifier_adds_spans_that_the_labelers_agree_on(spark):
    texts = [(i, f"call me at phone +1 (555) 010-{i:04d} today") for i in range(40)]
    texts += [(100 + i, f"my phone: 555-010-{i:04d} (mobile)") for i in range(40)]
    texts += [(200 + i, "nothing private here, only words and 12 numbers") for i in range(40)]
    rows = pii.find(spark, spark.createDataFrame(texts, "doc_id long, text string")).collect()
    found = {r.doc_id: [(s.kind, s.base, texts[[t[0] for t in texts].index(r.doc_id)][1][s.start : s.end]) for s in r.spans] for r in rows}
    assert found[3] == [("phone", True, "+1 (555) 010-0003")]
    assert found[105] == [("phone", False, "555-010-0005")]
    assert not any(found[200 + i] for i in range(40))


def test_em_orders_the_labelers(spark):
    r = random.Random(1)
    rows = []
    for _ in range(4000):
        private = r.random() < 0.4
        votes = [int(r.random() < (p if private else q)) for p, q in ((0.95, 0.05), (0.9, 0.3), (0.6, 0.1), (0.9, 0.5), (0.97, 0.7))]
        rows.append(("email", votes, ["s"], 1))
    m = pii.reliabilities(spark.createDataFrame(rows, "kind string, votes array<int>, shape array<string>, n long")).first()
    assert abs(m.prior - 0.4) < 0.08
    assert np.allclose(m.hit, [0.95, 0.9, 0.6, 0.9, 0.97], atol=0.08) and np.allclose(m.alarm, [0.05, 0.3, 0.1, 0.5, 0.7], atol=0.08)


# ---- 2 ----------------------------------------------------------------------
def test_schedule_has_the_targets_in_every_prefix(spark):
    docs = spark.createDataFrame([(i, f"s{i % 4}", 5000 + 10 * i, str(i)) for i in range(400)], "doc_id long, source string, size long, order string")
    sources = mixing.targets(docs)
    slots = mixing.schedule(spark, sources).orderBy("slot").collect()
    weight = {r.sid: r.slots / r.all_slots for r in sources.collect()}
    assert len({s.slot for s in slots}) == len(slots)
    seen = Counter()
    for n, s in enumerate(slots, 1):
        seen[s.sid] += 1
        if n % 50 == 0 and n < 0.98 * len(slots):
            assert all(abs(seen[k] - n * w) <= 8 for k, w in weight.items())


def test_the_mix_is_its_slots_in_order(spark):
    rows = [(i if i % 3 else None, " ".join(["w"] * (900 + 37 * (i % 50))), f"s{i % 4}" if i % 4 else None) for i in range(240)] + [(1, None, "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = sorted((tuple(r) for r in mixing.mix(spark, docs.repartition(3)).collect()), key=lambda r: r[:2])
    assert mix == sorted((tuple(r) for r in mixing.mix(spark, docs.repartition(7)).collect()), key=lambda r: r[:2])
    got = {(r.source): (r.target, r.source_size) for r in mixing.targets(mixing.sizes(docs)).collect()}
    total = sum(r[6] for r in mix)
    ends, seen, taken = {}, Counter(), Counter()
    for slot, at, _, doc_id, source, first, words in mix:  # pieces fill their slot without gaps
        assert at == ends.get(slot, 0) and words > 0 and first >= 0
        ends[slot] = at + words
        seen[source] += words
        taken[doc_id, source] += words
        done = sum(seen.values())
        if done > total / 10:
            assert all(abs(seen[s] - done * target / total) <= 6 * mixing.BLOCK for s, (target, _) in got.items())
    assert all(n <= mixing.BLOCK for n in ends.values()) and all(abs(seen[s] - target) < 1 for s, (target, _) in got.items())
    asked = Counter()
    for r in mixing.taken(spark, mixing.sizes(docs), "source").collect():
        asked[r.doc_id, r.source] += r.taken
    assert +asked == taken


def test_rows_without_a_key_spread_over_the_buckets(spark):
    docs = spark.createDataFrame([(None, f"text number {i}", "s") for i in range(900)], "doc_id long, text string, source string")
    order = [r.order[:1] for r in mixing.sizes(docs).collect()]
    assert max(Counter(order).values()) < 100


def test_mixed_documents_follow_what_is_taken(spark):
    rows = [(i, " ".join(["w%d" % j for j in range(20 + i % 7)]) + " ", f"s{i % 3}") for i in range(300)] + [(7, "  again  x ", None), (7, "  again  x ", None), (8, None, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, row string, time int")
    words = Counter()
    for r in mixing.mixed(spark, docs).collect():
        words[r.doc_id, r.source] += len(plain.WORD.findall(r.text))
        assert r.row == "x" and r.time == 1
    taken = Counter()
    for r in mixing.op2_of(spark, docs.select("doc_id", "text", "source")).withColumn("s", F.lit(1)).collect():
        taken[r.doc_id] += r.taken
    got = Counter()
    for (doc_id, _), n in words.items():
        got[doc_id] += n
    assert {k: v for k, v in taken.items() if v and k not in (7, 8)} == {k: v for k, v in got.items() if k not in (7, 8)}


# ---- 3 ----------------------------------------------------------------------
def families(seed: int, edits: float, members: int = 60, length: int = 80) -> list[str]:
    r = random.Random(seed)
    base = [f"w{r.randrange(5000)}" for _ in range(length)]
    return [" ".join(w if r.random() > edits else f"e{r.randrange(10**6)}" for w in base) for _ in range(members)]


@pytest.mark.parametrize("shingle,num,tile", [(3, 90, 256), (3, 90, 8), (5, 80, 8), (5, 80, 256), (1, 50, 8)])
def test_join_equals_brute_force(spark, monkeypatch, shingle, num, tile):
    """Small tiles force the tiled path, with several components in a block."""
    monkeypatch.setattr(jaccard, "TILE_SETS", tile)
    monkeypatch.setattr(jaccard, "PAIR_SETS", max(2, tile // 2))
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0 if tile < 100 else 500_000)
    texts = [t for seed, edits in enumerate((0.002, 0.005, 0.01, 0.02, 0.03, 0.08)) for t in families(seed, edits)]
    texts += [f"{a} {b}" for a in "pqr" for b in "stu"] + ["a b c d e f g h i j k"] * 3 + [None, ""]
    random.Random(3).shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(spark, docs, shingle, num, 100).collect()}
    sets = [plain.shingles(t, shingle) for t in texts]
    want = {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, plain.components(sets, num, 100)))}
    assert got == want and len(set(c for _, c in want.values())) < len(texts)


def test_one_of_each(spark, documents):
    docs = spark.createDataFrame([(d["doc_id"], d["text"], "x", 1) for d in documents], "doc_id long, text string, row string, text_key int")
    left = jaccard.one_of_each(spark, docs).collect()
    sets = [plain.shingles(d["text"], 5) for d in documents]
    roots = plain.components(sets, 80, 100)
    assert len(left) == len({r for r, s in zip(roots, sets) if s}) + sum(not s for s in sets)
    assert {r.row for r in left} == {"x"} and {r.text_key for r in left} == {1}


def test_first_shingles_of_linked_sets_are_shared():
    r = np.random.default_rng(4)
    seen = 0
    for num, den in ((90, 100), (80, 100), (60, 100), (30, 100)):
        for _ in range(400):
            a = np.unique(r.integers(0, 2**64, int(r.integers(1, 120)), dtype=np.uint64))
            kept = a[r.random(len(a)) > r.random() * 0.3]
            b = np.unique(np.concatenate([kept, r.integers(0, 2**64, int(r.integers(0, 8)), dtype=np.uint64)]))
            if len(b) and jaccard.linked(len(np.intersect1d(a, b)), len(a), len(b), num, den):
                seen += 1
                (look_a, enough_a, one_a), (look_b, enough_b, one_b) = (jaccard.prefix_sizes(len(x), num, den) for x in (a, b))
                assert np.intersect1d(a[:look_a], b[:look_b]).size >= max(enough_a, enough_b)
                assert np.intersect1d(a[:one_a], b[:one_b]).size
    assert seen > 200


def test_tree_bounds_never_drop_a_link():
    r = np.random.default_rng(2)
    base = r.integers(0, 2**64, 200, dtype=np.uint64)
    sets = [np.unique(np.where(r.random(200) < p, r.integers(0, 2**64, 200, dtype=np.uint64), base)) for p in (0, 0.01, 0.02, 0.05, 0.1) for _ in range(12)]
    links = jaccard.tree_links(sets, list(range(len(sets))), 90, 100)
    root = list(range(len(sets)))
    for i, j in links:
        x, y = (min(k for k in range(len(sets)) if root[k] == root[v]) for v in (i, j))
        root = [min(x, y) if root[k] in (root[x], root[y]) else root[k] for k in range(len(sets))]
    want = plain.components([frozenset(s.tolist()) for s in sets], 90, 100)
    assert len({*root}) == len({*want})


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(1000, 2000 + i) for i in range(50)]
    got = {r.node: r.root for r in graph.components(spark, spark.createDataFrame(path + star + [(7, 7)], "a long, b long")).collect()}
    assert set(got[i] for i in range(41)) == {0} and set(got[2000 + i] for i in range(50)) == {1000}


# ---- 4 ----------------------------------------------------------------------
def test_sketches_merge_and_estimate(spark):
    r = random.Random(9)
    words = [f"w{r.randrange(10**6)}" for _ in range(4000)]
    a, b = " ".join(words[:3000]), " ".join(words[1000:])
    df = spark.createDataFrame([(a, b, " ".join(words[:2004]), " ".join(words[2000:3000]))], "a string, b string, a1 string, a2 string")
    s = {c: fingerprint.sketch(F.col(c)) for c in df.columns}
    row = df.select(
        fingerprint.resemblance(s["a"], s["b"]).alias("j"),
        fingerprint.containment(s["a"], s["b"]).alias("c"),
        fingerprint.distinct_shingles(s["a"]).alias("n"),
        (fingerprint.merge(s["a1"], s["a2"]) == s["a"]).alias("merged"),
        (fingerprint.from_text(fingerprint.as_text(s["a"])) == s["a"]).alias("text"),
    ).first()
    assert abs(row.j - 0.5) < 0.15 and abs(row.c - 2 / 3) < 0.2 and abs(row.n / 2996 - 1) < 0.3 and row.merged and row.text
    parts = df.select(F.explode(F.array("a1", "a2")).alias("t")).select(fingerprint.sketch(F.col("t")).alias("sk"))
    assert parts.agg(fingerprint.merged("sk").alias("m")).first().m == df.select(s["a"].alias("m")).first().m


def test_sketches_merge_by_key(spark):
    rows = [("a", list(range(i, i + 90, 3))) for i in range(200)] + [("b", []), ("b", None), (None, [3, 1]), (None, [2, 3])]
    df = spark.createDataFrame([(k, sorted(v) if v is not None else None) for k, v in rows], "source string, sketch array<long>")
    got = {r["source"]: r["sketch"] for r in fingerprint.merged_by(df, ["source"], "sketch").collect()}
    assert got == {"a": list(range(128)), "b": [], None: [1, 2, 3]}
    plan = fingerprint.merged_by(df, ["source"], "sketch")._jdf.queryExecution().toString()
    assert "collect_set" not in plan and "WindowGroupLimit" in plan


# ---- 5 ----------------------------------------------------------------------
PIECES = st.sampled_from(["<s>", "</s>", " </s>", "[INST] ", " [/INST]", "<<SYS>>\n", "\n<</SYS>>\n\n", "<|", "|>", "<|end|>", "\\", "<\\s>", "[\\INST]", "<", "[", "s>", "a", " ", "\n", "é😀", "|"])
TEXTS = st.lists(PIECES, max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["system", "user", "assistant", "tool", ""]), TEXTS), TEXTS), max_size=6))
def test_chat_round_trip(turns):
    formatted, loss = chat.format_turns(turns)
    assert chat.read(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]
    assert not any(chat.BARE.search(text) for _, text, _, _ in chat.parse(formatted))


def test_a_long_conversation_streams_by(spark):
    """Conversations of many slices, next to each other, give what a whole rendering gives."""
    texts = ["plain", "a [/INST] b </s>", "[\\INST]", "", "é😀"]
    talks = {c: [(("user", "assistant", "tool|x", "system")[i % 4], texts[(i + n) % 5]) for i in range(n)] for c, n in [(None, 3000), (1, 1), (2, 2500), (3, 7)]}
    table = [(c, i, *t) for c, turns in talks.items() for i, t in enumerate(turns)]
    random.Random(1).shuffle(table)
    formatted = chat.format_conversations(spark.createDataFrame(table, "conv_id long, turn long, role string, text string").repartition(5))
    plan = formatted._jdf.queryExecution().toString()
    assert "collect_list" not in plan
    pieces = {c: sorted((r for r in formatted.collect() if r.conv_id == c), key=lambda r: r["at"]) for c in talks}
    for c, turns in talks.items():
        whole, loss = chat.format_turns(turns)
        assert len(pieces[c]) == len(turns) and "".join(r.formatted for r in pieces[c]) == whole
        assert [tuple(r.loss) for r in pieces[c] if r.loss] == loss
    digests = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for c, turns in talks.items():
        learned = "".join(t for role, t in turns if role == "assistant")
        source = "".join(f"{a}\n{b}\n" for a, b in turns)
        assert digests[c][1:] == (len(turns), plain.sha(source), len(learned), plain.sha(learned), len(chat.format_turns(turns)[0]))


# ---- 6 ----------------------------------------------------------------------
@pytest.fixture(scope="module")
def tokenizer():
    return bpe.Tokenizer(bpe.load(bpe.public_path()))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_bpe_equals_the_library(tokenizer, text):
    tokenizers = pytest.importorskip("tokenizers")
    global REFERENCE
    REFERENCE = globals().get("REFERENCE") or tokenizers.Tokenizer.from_file(bpe.public_path())
    ids = tokenizer.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == REFERENCE.encode(text, add_special_tokens=False).ids
    assert tokenizer.decode(ids) == text


def test_bpe_of_a_very_long_word_and_a_small_memory(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 3)
    text = "ab" * 40_000 + " the cat the dog the end of it all of it"
    ids = tokenizer.encode(text)
    assert tokenizer.decode(ids) == text and len(tokenizer.memory) <= 3


# ---- 7 ----------------------------------------------------------------------
def test_a_map_depends_on_the_number_of_shards_alone(spark):
    slots = lambda m: {r.vslot: r.shard for r in m.collect()}
    for n in (1, 2, 7, 40):
        now, grown = sharding.map_of(spark, n), sharding.grown_map(sharding.map_of(spark, n), n)
        one, two = slots(now), slots(grown)
        assert two == slots(sharding.map_of(spark, n + 1)) and {r.version for r in grown.collect()} == {n + 1}
        assert all(two[s] in (one[s], n) for s in one) and set(two.values()) == set(range(n + 1))
        held = Counter(two.values())
        assert max(held.values()) < 1.3 * sharding.SLOTS / (n + 1) and min(held.values()) > 0.7 * sharding.SLOTS / (n + 1)


@pytest.mark.parametrize("shards", [1, 7])
def test_grown_shards_are_the_shards_of_the_larger_map(spark, awkward, shards):
    known = lambda n, c: Counter((r.doc_id, r.text_crc32, r[c]) for r in sharding.op7_sharding(spark, awkward, n).collect())
    assert known(shards, "grown_shard") == known(shards + 1, "shard")


def test_rebalancing_evens_the_bytes(spark):
    r = random.Random(2)
    loads = spark.createDataFrame([(s, 1, int(r.random() * 1000) + 3000 * (s % 4 == 0)) for s in range(4096)], "vslot int, slot_rows long, slot_bytes long")
    v1 = spark.range(4096).select(F.lit(1).alias("version"), F.col("id").cast("int").alias("vslot"), (F.col("id") % 4).cast("int").alias("shard"))
    v2 = sharding.rebalanced_map(v1, loads, 4)

    def spread(m):
        held = [x.b for x in m.join(loads, "vslot").groupBy("shard").agg(F.sum("slot_bytes").alias("b")).collect()]
        return max(held) / (sum(held) / 4)

    assert v2.count() == 4096 and spread(v1) > 1.5 and spread(v2) < 1.01
    one, two = ({x.vslot: x.shard for x in m.collect()} for m in (v1, v2))
    assert sum(one[s] != two[s] for s in one) < 2048


# ---- 8 ----------------------------------------------------------------------
def test_ledger_scans_only_unseen_pairs(spark):
    ledger = secrets.new_ledger(spark)
    first = spark.createDataFrame([(1, "password=abcdef1"), (2, "password=abcdef1"), (3, None)], "doc_id long, text string")
    second = first.unionByName(spark.createDataFrame([(4, "AKIA" + "A" * 16), (5, "password=abcdef1")], "doc_id long, text string"))
    for docs, blobs in ((first, 2), (first, 2), (second, 3)):
        rows = {r.doc_id: [s.kind for s in r.spans] for r in secrets.scan(spark, docs, ledger).collect()}
        assert spark.read.parquet(ledger).count() == blobs
        assert rows == {d.doc_id: {1: ["assign"], 2: ["assign"], 3: [], 4: ["access"], 5: ["assign"]}[d.doc_id] for d in docs.collect()}
    secrets.scan(spark, second, ledger, rules=1).count()
    assert spark.read.parquet(ledger).count() == 6


def test_redaction_of_whole_private_keys(spark):
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    encrypted = f"{begin}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\nMIIBody+/=\n{end}"
    in_json = '{"key": "' + f"{begin}\\nMIIBody+/=\\n{end}" + '\\n"}'
    texts = [f"x {encrypted} y", in_json, f"{begin} cut MIIstays {encrypted}", "a ----- b " + encrypted + " c -- d " + encrypted]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in secrets.redact(spark, df).collect()}
    assert got[0] == "x [SECRET] y" and got[1] == '{"key": "[SECRET]\\n"}'
    assert got[2] == "[SECRET] cut MIIstays [SECRET]" and got[3] == "a ----- b [SECRET] c -- d [SECRET]"


def test_redaction_joins_overlapping_spans(spark):
    text = 'é token = "' + "a1" * 20 + '" end AKIA' + "B" * 16
    docs = spark.createDataFrame([(1, text, "x"), (2, "clean", "y"), (3, None, "z")], "doc_id long, text string, spans string")
    assert sorted(map(tuple, secrets.redact(spark, docs).collect())) == [(1, 'é [SECRET]" end [SECRET]', "x"), (2, "clean", "y"), (3, None, "z")]


# ---- 9 ----------------------------------------------------------------------
def test_folded_model_equals_the_kernel():
    """The matrix of n-grams gives what kernel ridge regression over the landmarks gives."""
    r = random.Random(3)
    text = lambda syllables: " ".join("".join(r.choice(syllables) for _ in range(3)) for _ in range(20))
    rows = [(lang, language.ngrams(text(s))[0]) for lang, s in (("x", ["an", "be", "ku"]), ("y", ["or", "li", "be"])) for _ in range(12)]
    langs, matrix = language.fit(rows)

    def kernel(a, b):
        return sum(
            len(np.intersect1d(x, y)) / np.sqrt(len(x) * len(y)) / language.ORDERS
            for n in range(language.ORDERS)
            for x, y in [[i[i // language.BUCKETS == n] for i in (a, b)]]
        )

    gram = np.array([[kernel(a, b) for _, b in rows] for _, a in rows])
    values, vectors = np.linalg.eigh(gram)
    good = values > 1e-6 * values[-1]
    z = np.hstack([gram @ vectors[:, good] / np.sqrt(values[good]), np.ones((24, 1))])
    y = np.array([[1.0 if lang == c else -1.0 for c in langs] for lang, _ in rows])
    w = np.linalg.solve(z.T @ z + language.RIDGE * 12 * np.eye(z.shape[1]), z.T @ y)
    margins = np.array([(matrix[i] * (1 / np.sqrt(language.ORDERS * np.bincount(i // language.BUCKETS)[i // language.BUCKETS]))[:, None]).sum(0) + matrix[-1] for _, i in rows])
    assert np.allclose(margins, z @ w, atol=1e-3)


# ---- 10 ---------------------------------------------------------------------
@pytest.mark.parametrize("dims", [1, 7, 16, 64])
def test_search_equals_brute_force(dims):
    r = np.random.default_rng(dims)
    vectors = np.vstack([r.integers(-300, 300, (400, dims)), np.zeros((5, dims), np.int64), np.full((6, dims), 9)])
    ids = np.arange(len(vectors)) * 3
    got = topk.search(vectors[:60], ids[:60], vectors, ids)
    want = [(i, *x) for i in range(60) for x in plain.best(list(zip(ids.tolist(), vectors.tolist())), (int(ids[i]), vectors[i].tolist()))]
    assert got == want


def test_search_for_many_neighbours():
    r = np.random.default_rng(5)
    vectors = r.integers(-300, 300, (2000, 32))
    ids = np.arange(len(vectors))
    for k in (50, 1995, 3000):
        got = topk.search(vectors[:20], ids[:20], vectors, ids, k)
        assert got == [(i, *x) for i in range(20) for x in plain.best(list(zip(ids.tolist(), vectors.tolist())), (i, vectors[i].tolist()), k)]


# ---- 9 ----------------------------------------------------------------------
def test_the_sample_does_not_depend_on_partitions(spark):
    r = random.Random(8)
    rows = [(None, " ".join(r.choice(["ab", "cd", "ef", "gh"]) for _ in range(6)), "en") for _ in range(3000)] + [(None, f"eau ré {i}", "fr") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = [[(lang, tuple(x)) for lang, x in language.sampled(docs.repartition(n))] for n in (3, 7)]
    assert samples[0] == samples[1] and len(samples[0]) > 1000


# ---- 11 ---------------------------------------------------------------------
def test_search_over_many_segments_and_ranges_is_exact(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SEGMENT", 50)
    monkeypatch.setattr(lexical, "RANGE", 8)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 25)
    r = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    heavy = [1 / (i + 1) for i in range(60)]
    texts = [(r.randrange(400), " ".join(r.choices(words, heavy, k=r.randint(0, 40)))) for _ in range(700)] + [(None, "w1 w2")] * 3
    items = [(i, " ".join(r.choices(words, k=r.randint(1, 12)))) for i in range(40)]
    want = plain.ranked([(i, plain.terms(t)) for i, t in texts], {i: set(plain.terms(t)) for i, t in items}, 7)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = {}
    for x in lexical.rank(spark, docs, spark.createDataFrame(items, "query_id long, text string"), k=7).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.doc_id, x.score))
    assert {i: sorted(v, key=lambda x: x[0]) for i, v in got.items()} == {i: v for i, v in want.items() if v}


def test_ranges_below_the_threshold_are_skipped():
    edges = np.arange(0, 108, 8)
    long_ = lexical.Postings(np.arange(100), np.full(100, 5), edges)
    rare = lexical.Postings(np.array([3, 90]), np.array([100, 200]), edges)
    asked = []
    long_.within = lambda r: asked.append(r) or lexical.Postings.within(long_, r)
    best = lexical.Best(2)
    lexical.search([long_, rare], 100, edges, best, np.arange(100), np.zeros(100, bool))
    assert list(best.score) == [205, 105] and list(best.doc_id) == [90, 3]
    best.least = 150
    asked.clear()
    lexical.search([long_, rare], 100, edges, best, np.arange(100), np.zeros(100, bool))
    assert asked == [11]  # only the range of the document at 90 can reach the threshold


# ---- 12 ---------------------------------------------------------------------
def test_hash_index_is_minimal_and_knows_its_keys():
    r = np.random.default_rng(4)
    ids = np.concatenate([np.arange(3000), np.zeros(2000, np.int64), r.integers(-(1 << 62), 1 << 62, 3000)])
    copies = np.concatenate([np.zeros(3000, np.int64), np.arange(1, 2001), np.full(3000, -1)])
    places = {"shard": np.arange(8000) % 7, "offset": np.arange(8000) * 3, "n_tokens": np.arange(8000) % 5}
    index = tokenfile.HashIndex.load(tokenfile.HashIndex.build(ids, copies, places).dump())
    known, number = index.find(ids, copies)
    assert known.all() and sorted(number.tolist()) == list(range(8000))
    assert all((index.fields[f][number] == places[f]).all() for f in places)
    known, _ = index.find(np.arange(10_000, 60_000), np.zeros(50_000, np.int64))
    assert known.sum() <= 1
    empty = tokenfile.HashIndex.load(tokenfile.HashIndex.build(ids[:0], copies[:0], {f: places[f][:0] for f in places}).dump())
    assert not empty.find(ids, copies)[0].any()
    with pytest.raises(ValueError):
        tokenfile.HashIndex.build(np.zeros(2, np.int64), np.zeros(2, np.int64), {f: places[f][:2] for f in places})


def test_a_key_that_holds_most_rows_spreads_over_shards(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(tokenfile, "LEAST_PART_KEYS", 100)
    rows = [(7, "the same text of words")] * 900 + [(None, f"no key {i}") for i in range(300)] + [(i, f"text {i} <|endoftext|> \x01 x") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = tokenfile.write(spark, docs, out=str(tmp_path / "t"), shard_bytes=4000)
    places = spark.read.parquet(f"{path}/places")
    shards = {x.shard: x.n for x in places.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    assert len(shards) > 5 and max(shards.values()) < 500
    reader, encoder = tokenfile.Reader(path), tokenfile.Encoder(open(tokenfile.public_path()).read())
    assert reader.parts > 1
    for doc_id, copy, text in ((7, 0, rows[0][1]), (7, 900, "text 7 <|endoftext|> \x01 x"), (12, 0, "text 12 <|endoftext|> \x01 x")):
        texts = {rows[0][1], "text 7 <|endoftext|> \x01 x"} if doc_id == 7 else {text}
        assert reader.get(doc_id, copy).tolist() in [[*encoder.ids(t), 2] for t in texts]
    assert reader.get(7, 901) is None and reader.get(10**6) is None and reader.get(None, 299) is not None and reader.get(None, 300) is None
    asked = spark.createDataFrame([(7, 5), (7, 5), (8, 0), (8, 1), (None, 2)], "doc_id long, copy long")
    got = {(x.doc_id, x.copy): x for x in tokenfile.read(spark, path, asked).collect()}
    assert set(got) == {(7, 5), (8, 0), (None, 2)} and got[8, 0].ids == [*encoder.ids("text 8 <|endoftext|> \x01 x"), 2]
    parts = places.select("doc_id", "copy", tokenfile.part_column(11).alias("part")).collect()
    assert all(x.part == tokenfile.part_of(x.doc_id, x.copy, 11) for x in parts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text("aeSTéÉßÿþÞµªºİ.,;:!?'’ \u0301\t\x85\xa0<|endoftext|>12-#<|>*@\x00\x01\x1f×÷", max_size=60), max_size=6))
def test_words_encode_as_whole_texts_do(texts):
    encoder = ENCODERS.setdefault(0, None) or ENCODERS.setdefault(1, tokenfile.Encoder(open(tokenfile.public_path()).read()))
    for text, data in zip(texts, encoder.encode(pa.array(texts, pa.string()))):
        assert np.frombuffer(data, encoder.dtype).tolist() == [*encoder.ids(text), 2]


ENCODERS: dict = {}


# ---- 13 ---------------------------------------------------------------------
@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from([(1, 1), (3, 2), (40, 8), (512, 8)]))
def test_tiles_stitch_to_the_runs_of_the_whole(seed, size):
    r, before = random.Random(seed), (runs.TILE, runs.FACTOR)
    words = [b"%d" % r.randrange(r.choice([1, 2, 3, 40])) for _ in range(r.choice([4, 7, 30, 120, 400]))]
    for _ in range(r.randint(0, 4)):
        p, at = r.randint(1, max(1, len(words) // 4)), r.randrange(len(words))
        for i in range(at + p, min(len(words), at + r.randint(1, len(words)))):
            words[i] = words[i - p]
    runs.TILE, runs.FACTOR = size
    try:
        parts: dict = {}
        for octave, low, codes in runs.tiles(runs.coded(words)) if len(words) >= runs.LEAST else ():
            for p, a, b in runs.solve(octave, low, len(words), codes):
                parts.setdefault(p, []).append((a, b))
    finally:
        runs.TILE, runs.FACTOR = before
    found: dict = {}
    for p in sorted(parts):
        whole: list = []
        for a, b in sorted(parts[p]):
            if whole and a <= whole[-1][1]:
                whole[-1][1] = max(whole[-1][1], b)
            else:
                whole.append([a, b])
        for a, b in whole:
            if b - a + p >= max(6, 4 * p):
                found.setdefault((a, b - a + p), p)
    assert sorted((s, n, p) for (s, n), p in found.items()) == sorted(plain.runs(words))


def test_a_run_over_many_tiles_is_one(spark):
    block = [f"w{i}" for i in range(37)]
    text = "start " + " ".join(block * 120) + " end"
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, "x " * 9000)], "doc_id long, text string")
    rows = runs.find_runs(spark, docs).collect()
    assert [sorted((x.start, x.period, x.length) for x in r.runs) for r in rows if r.doc_id != 2] == [[(1, 37, 37 * 120)]] * 3
    assert [(x.start, x.period, x.length) for r in rows if r.doc_id == 2 for x in r.runs] == [(0, 1, 9000)]
