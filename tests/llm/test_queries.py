"""The registered queries against SQL, the contract's digests against brute force, and the pipeline."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import TESTDATA
from test_queries import canonical, views
from thornwall.llm import queries, quality, simhash, sql
from thornwall.llm.common import Scratch

SF = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def duck():
    return views(SF)


@pytest.mark.parametrize("name", sorted(sql.all_sql()))
def test_matches_sql(spark, duck, name):
    result = queries.registered()[name](spark, SF)
    cursor = duck.execute(sql.all_sql()[name])
    expected = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert canonical(result.columns, [tuple(r) for r in result.collect()]) == expected and expected[1]


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_license_query(spark, documents):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    found = queries.op1_license_scans(spark, SF).collect()
    assert {r["doc_id"] for r in found} == set(documents)
    for r in found:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", documents[r["doc_id"]]["text"].translate({c: c + 32 for c in range(65, 91)}))
        hits = [(k, label) for p, label in phrases.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        places = [k for k, _ in hits]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(hits), min(places, default=None), max(places, default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in hits})) and {*filter(None, r["base_labels"].split(","))} <= {*r["labels"].split(",")}


def test_license_query_judges_tags(spark, tmp_path):
    """Texts with identifier tags, which the given documents have none of."""
    texts = {
        1: "// SPDX-License-Identifier: MIT OR (GPL-2.0-only AND Apache-2.0)", 2: "SPDX-License-Identifier: GPL-3.0-only\nall rights reserved", 3: "no tag here", 4: None,
        5: "SPDX-License-Identifier: MIT AND GPL-3.0-only",
    }
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op1_license_scans(spark, str(tmp_path)).collect()}
    assert {i: r["permitted"] for i, r in found.items()} == {1: True, 2: False, 3: None, 4: None, 5: False}
    assert found[1]["expressions"] == "mit gpl-2.0-only apache-2.0 and or" and found[2]["base_labels"] == "reserved" and found[3]["expressions"] == ""


def test_language_query(spark, documents):
    found = queries.op6_language_id(spark, SF).collect()
    held_out = [r for r in found if r["held_out"]]
    assert len(found) == len(documents) and len(held_out) > 40
    assert sum(r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held_out) >= 0.97 * len(held_out)


def test_bpe_query(spark, documents):
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    from thornwall.llm.bpe import read_ranks

    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=read_ranks(tokenizers.path(queries.RANKS)), special_tokens={})
    for r in queries.op8_byte_bpe(spark, SF).collect():
        text = documents[r["doc_id"]]["text"]
        ids = library.encode_ordinary(text)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_native_queries_run_no_python(spark, monkeypatch):
    for name in ("op2_mixing", "op4_quality_rules", "op7_url_filters", "op9_exact_dedup", "op12_benchmark_decontamination"):
        plans, keep = [], Scratch.keep
        # Also what is stored on the way.
        monkeypatch.setattr(Scratch, "keep", lambda self, df, keep=keep, plans=plans: plans.append(df) or keep(self, df))
        plans.append(queries.registered()[name](spark, SF))
        monkeypatch.setattr(Scratch, "keep", keep)
        for df in plans:
            assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString()), name


def test_pipeline_stage_by_stage(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append([r["doc_id"] for r in docs.select("doc_id").collect()])
    good = {r["id"] for r in quality.judge(spark.read.parquet(f"{SF}/documents.parquet")).filter("kept").collect()}
    assert sorted(kept[0]) == sorted(good)
    least = {}
    for i in sorted(good):
        least.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", documents[i]["text"]), i)
    assert sorted(kept[1]) == sorted(least.values())
    fps, gone = {i: simhash.simhash(documents[i]["text"]) for i in kept[1]}, set()
    groups = {i: i for i in kept[1]}
    for a in sorted(fps):
        for b in sorted(fps):
            if b < a and (fps[a] ^ fps[b]).bit_count() <= 3:
                old, new = max(groups[a], groups[b]), min(groups[a], groups[b])
                groups = {k: new if g == old else g for k, g in groups.items()}
    gone = {i for i, g in groups.items() if g != i}
    assert sorted(kept[2]) == sorted(set(kept[1]) - gone)
    assert set(kept[3]) <= set(kept[2]) and all(kept[3].count(i) <= 3 for i in set(kept[3]))
    last = corpus_pipeline.run(spark, SF).agg(F.count("*"), F.countDistinct("doc_id")).first()
    assert tuple(last) == (len(kept[3]), len(set(kept[3])))


def test_pipeline_on_irregular_tables(spark, tmp_path):
    """Nulls, repeated rows, no rows at all."""
    good = " ".join(f"word{k} other{k}" for k in range(60))
    rows = [(None, good, "s"), (None, good, "s"), (1, good + " x", None), (1, good + " x", None), (2, None, "s"), (3, "", "t"), (4, good.upper(), "t"), (5, "é " + good[::-1], None)]
    for name, data in (("odd", rows), ("none", [])):
        frame = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in data], "doc_id long, text string, lang string, source string, n_chars long")
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {r["doc_id"] for r in found} <= {None, 1, 4, 5} and bool(found) == bool(data)
        assert all(r["n_tokens"] == len(r["ids"]) for r in found)
