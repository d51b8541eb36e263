"""The pipeline's stages on odd rows, and the whole run against brute force."""

import itertools
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from pricedex.llm.queries import ORACLE, QUERIES, read_table, tokenizer_path
from pricedex.plans.verify import compare, duckdb_views
from test_line_dedup import brute as brute_lines
from test_simhash import slow_fingerprint

SF = "/root/testdata/sf0.001"
CLASHING = ["_text_key", "_lang_pred", "lang_pred", "lang_score", "_language", "_posterior", "language", "posterior", "_id", "_key",
            "_cut", "row", "id", "key", "cut", "cut_id", "cut_key", "fp", "leaf", "line", "template", "component", "component_id",
            "ids", "piece", "length", "_times", "score", "_item", "words", "sums"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
BENCH = "/root/testdata/sf0.001/benchmark.parquet"


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_with_sql(spark, con, name):
    ok, message, _ = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert ok, message


def odd_rows(spark):
    item = spark.read.parquet(BENCH).first().text
    base = "plain words of a document that says something of its own"
    rows = [(1, base + " first"), (2, None), (3, ""), (4, " 123 ,.! "), (None, "a text without an id that stays"),
            (6, base + " sixth and some more words follow here"), (6, base + " sixth and some more words follow here"),
            (7, "long " + "words " * 40_000), (8, f"text around {item} and after"), (9, "same text twice in the table here"),
            (10, "same text twice in the table here"), (11, "shared line of five words or more\nown eleven words"),
            (12, "shared line of five words or more\nanother twelfth"), (13, "shared line of five words or more\nthird of thirteen")]
    return spark.createDataFrame([(i, t, None if i == 12 else "en", None, len(t or ""), *CLASHING) for i, t in rows], SCHEMA)


def test_stages_on_odd_rows(spark):
    docs, seen = odd_rows(spark), {}
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd_rows(spark).columns
        assert all([r[c] for c in CLASHING] == CLASHING for r in docs.collect())
        docs = spark.createDataFrame(docs.collect(), SCHEMA)
        seen[name] = {(r.doc_id, r.text) for r in docs.collect()}
    assert {i for i, _ in seen["language_id"]} == {1, None, 6, 7, 8, 9, 10, 11, 12, 13}
    assert {(11, "shared line of five words or more\nown eleven words"), (12, "another twelfth")} <= seen["line_dedup"]
    ids = [i for i, _ in seen["simhash_near_dedup"]]
    assert 9 in ids and 10 not in ids and {1, 6, 7, 11, 12, 13, None} <= set(ids)
    assert {i for i, _ in seen["decontamination"]} == set(ids) - {8}
    packed = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(ids) - {8}


@pytest.mark.parametrize("stage", range(len(P.STAGES)))
def test_stages_on_an_empty_table(spark, stage):
    assert P.STAGES[stage][1](spark, spark.createDataFrame([], SCHEMA), SF).count() == 0


def brute_near_dedup(rows):
    fps = {}
    for doc_id, text in rows:
        fps.setdefault(slow_fingerprint(text, 4), []).append(doc_id)
    label = {f: f for f in fps}

    def find(f):
        while label[f] != f:
            f = label[f]
        return f

    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 4:
            label[find(a)] = find(b)
    groups = {}
    for f, ids in fps.items():
        groups.setdefault(find(f), []).extend(ids)
    return {min(ids) for ids in groups.values()}


def test_run_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    rows = [(i, t) for i, t in rows if re.search(r"[^\W\d_]", t)]  # the table's languages are certain
    rows = [(i, t) for i, t, _ in brute_lines(rows)]
    keep = brute_near_dedup(rows)
    rows = [(i, t) for i, t in rows if i in keep]
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [plain(r.text) for r in read_table(spark, SF, "benchmark").collect()]
    exact = {i for i, t in rows if any(b in plain(t) for b in items)}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    lengths = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows if i not in exact}
    packed = P.run(spark, SF).collect()
    got = Counter()
    for r in packed:
        got[r.doc_id] += r.length
    assert got == lengths  # the table's passages are exact, so nothing else is within the edit budget
    room = Counter()
    for r in packed:
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 1024 and len(room) <= -(-sum(room.values()) // 1024) * 1.03 + 1
