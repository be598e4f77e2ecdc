"""The corpus pipeline, stage by stage and as a whole."""

from __future__ import annotations

import random
from collections import Counter

import plain
import pytest

import corpus_pipeline as pipeline
from strata.llm.common import written

NAMES = [n for n, _ in pipeline.STAGES]


@pytest.fixture(scope="module")
def stages(spark, awkward):
    """The rows each stage was given and gave."""
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    out = {}
    for name, stage in pipeline.STAGES:
        got = written(spark, stage(spark, docs, awkward), "test")
        out[name] = (docs, got)
        docs = got
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_columns_stay(stages):
    for name in NAMES[:-1]:
        before, after = stages[name]
        assert after.columns == before.columns


def test_language_stage(stages):
    before, after = (rows(df) for df in stages["language_id"])
    letters = [r for r in before if any(map(str.isalpha, r["text"] or ""))]
    assert Counter(map(str, after)) <= Counter(map(str, letters))
    assert len(letters) - len(after) <= 2


@pytest.mark.parametrize("count", [1, 2, 4, 8])
def test_language_stage_with_other_numbers_of_languages(spark, count):
    r = random.Random(count)
    spoken = [["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=2)) for _ in range(24)] for _ in range(count + 2)]
    text = lambda i, n: " ".join("".join(r.choice(spoken[i]) for _ in range(r.randint(1, 3))) for _ in range(n))
    labelled = [(text(i, 60), f"l{i}") for i in range(count) for _ in range(40)]
    short = [text(i, 4) for i in range(count) for _ in range(10)]
    two = [text(i, 30) + " " + text((i + 1) % count, 30) for i in range(count)]
    unknown = [text(count + i % 2, 60) for i in range(20)]
    table = [(i, *x, "s", len(x[0])) for i, x in enumerate([*labelled, *((t, None) for t in short + two + unknown)])]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["text"] for r in rows(pipeline.language_id(spark, docs, ""))}
    assert {t for t, _ in labelled} <= kept and set(two) <= kept and set(short) <= kept
    assert not kept & set(unknown)


def test_near_duplicates_stage(stages):
    before, after = (rows(df) for df in stages["ngram_jaccard_join"])
    sets = [plain.shingles(r["text"], 5) for r in before]
    groups = plain.components(sets, 80, 100)
    assert len(after) == len({*groups})
    least = {}
    for r, g in zip(before, groups):
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        least[g] = min(least.get(g, key), key)
    assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in after) == Counter(least.values())


def test_secret_stage(stages):
    before, after = (rows(df) for df in stages["secret_scan"])
    assert len(before) == len(after) and not any(plain.secret(r["text"]) for r in after)
    clean = {str(r) for r in before if not plain.secret(r["text"]) and "PRIVATE KEY" not in r["text"]}
    assert len(clean & {str(r) for r in after}) >= len(clean) - sum(r["n_chars"] != len(r["text"]) for r in before)
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_mixing_stage(stages):
    before, after = (rows(df) for df in stages["source_mixing"])
    size = lambda r: len(plain.WORD.findall(r["text"] or ""))
    sizes, got = Counter(), Counter()
    for r in before:
        sizes[r["source"]] += size(r)
    for r in after:
        got[r["source"]] += size(r)
    targets = plain.targets(sizes)
    assert all(abs(got[s] - targets[s]) <= 1 for s in sizes)
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}


def test_tokens_stage(stages):
    before, after = (rows(df) for df in stages["bpe"])
    assert Counter((r["doc_id"], plain.sha(r["text"] or "")) for r in before) == Counter((r["doc_id"], r["decoded_sha256"]) for r in after)


def test_run_equals_the_stages(spark, awkward, stages):
    assert Counter(map(str, rows(pipeline.run(spark, awkward)))) == Counter(map(str, rows(stages["bpe"][1])))


def test_empty_tables(spark, empty):
    assert pipeline.run(spark, empty).collect() == []
