"""Registered queries against their SQL and their contracts, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import random
import zlib

import __spark_entry__ as driver
import corpus_pipeline
import duckdb
import numpy as np
import oracle
import public_tokenizers
import pytest
from conftest import DATA
from tokenizers import Tokenizer

from llm.test_links import brute
from tillmart.llm import language, line_dedup, queries


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(DATA)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, connection, name):
    found = oracle.spark_bag(queries.QUERIES[name](spark, DATA))
    assert found == oracle.duck_bag(connection, queries.SQL[name])
    assert sum(found[1].values()) > 0


def test_all_are_registered():
    names = set(driver.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert set(queries.SQL) <= set(driver.oracle_sql())


@pytest.fixture(scope="module")
def texts(connection):
    return dict(connection.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def test_bpe_contract(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.op7_bpe(spark, DATA).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_packing_contract(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = queries.op10_packing(spark, DATA).collect()
    lengths = {}
    for row in rows:
        ids = np.array(library.encode(texts[row.doc_id], add_special_tokens=False).ids + [1], "<u4")
        part = ids[row.start : row.start + row.length]
        assert row.doc_tokens == len(ids) and row.ids_crc32 == zlib.crc32(part.tobytes())
        lengths[row.sequence_id] = lengths.get(row.sequence_id, 0) + row.length
    assert {r.doc_id for r in rows} == set(texts)
    assert all(n <= 2048 for n in lengths.values())


def test_language_contract(spark, connection):
    labels = dict(connection.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = queries.op2_language(spark, DATA).collect()
    assert len(rows) == len(labels)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_rollup_query(spark, connection):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = connection.execute(
        "SELECT d.doc_id, coalesce(text, ''), source, lang, coalesce(toxic, 0), coalesce(quality, 1) "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
    ).fetchall()
    wanted = {}
    for _, text, source, lang, toxic, quality in rows:
        if toxic == 1:
            continue
        end = quality == 0
        key = (source, lang, "word-bpe-49k" + ("-end" if end else ""))
        docs, tokens, chars = wanted.get(key, (0, 0, 0))
        count = len(library.encode(text, add_special_tokens=False).ids) + end
        wanted[key] = (docs + 1, tokens + count, chars + len(text))
    found = queries.op8_token_rollup(spark, DATA).collect()
    assert {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens, r.chars) for r in found} == wanted


# --- pipeline ---------------------------------------------------------------------------

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    frames = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], DATA).write.parquet(f"{folder}/{number}")
        frames.append(spark.read.parquet(f"{folder}/{number}"))
    return frames


def test_stages_keep_the_columns_of_documents(staged):
    assert len(corpus_pipeline.STAGES) == 4
    for frame in staged[1:-1]:
        assert frame.dtypes == staged[0].dtypes


def test_language_stage_takes_out_only_what_it_cannot_tell(staged):
    left = {r.doc_id for r in staged[1].collect()}
    gone = [r for r in staged[0].collect() if r.doc_id not in left]
    model = language.learn(staged[0])
    names, scores, _, doubts = language.judged(model, [r.text for r in gone])
    least, most = corpus_pipeline.LEAST_SCORE, corpus_pipeline.MOST_DOUBT
    assert all(n == "und" or s < least or d > most for n, s, d in zip(names, scores, doubts))
    # Every document here is in a labelled language; only texts without letters go.
    assert all(not any(sign.isalpha() for sign in r.text or "") for r in gone)


def test_language_stage_rejects_unlabelled_languages(spark, staged):
    """Texts in other languages, another script and of letters at random, beside all documents."""
    draw = random.Random(5)
    polish = "każdy człowiek powinien wiedzieć dokąd prowadzi droga którą wybrał wczoraj wieczorem "
    russian = "каждый вечер мы читали старые письма возле окна и пили горячий чай с вареньем "
    junk = " ".join("".join(draw.choice("bcdfgjkqvwxz") for _ in range(draw.randint(4, 9))) for _ in range(60))
    odd = {9_000_001: polish * 8, 9_000_002: russian * 8, 9_000_003: junk, 9_000_004: "Kraków"}
    more = spark.createDataFrame([(k, v, None, "odd", len(v)) for k, v in odd.items()], SCHEMA)
    docs = staged[0].unionByName(more)
    left = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, DATA).collect()}
    assert left & set(odd) == {9_000_004}
    assert left - set(odd) == {r.doc_id for r in staged[1].collect()}


def test_line_stage_against_sql(staged):
    """All lines of the stage's own input, compared by the statement of the query."""
    held = duckdb.connect()
    held.register("documents", staged[1].toPandas())
    wanted = held.execute(f"SELECT doc_id, n_dropped, text FROM ({line_dedup.SQL_TEXT})").fetchall()
    given = {r.doc_id: r.text or "" for r in staged[1].collect()}
    own = {key: len("\n".join(dict.fromkeys(text.split("\n")))) for key, text in given.items()}
    left = {key: text for key, dropped, text in wanted
            if not dropped or (text and text.strip(" ") and 100 * (own[key] - len(text)) < 80 * own[key])}
    found = {r.doc_id: r for r in staged[2].collect()}
    assert {key: r.text for key, r in found.items()} == left
    assert any(dropped for _, dropped, _ in wanted)
    assert all(r.n_chars == len(r.text) for r in found.values())


def test_line_stage_drops_what_is_left_of_near_copies(spark):
    draw = random.Random(2)
    lines = [" ".join(str(draw.randint(10_000, 99_999)) for _ in range(14)) for _ in range(60)]
    texts = {1: lines[:20], 2: [*lines[:19], lines[40]], 3: [*lines[:10], *lines[41:46]],
             4: [lines[50], *[lines[51]] * 30], 5: [lines[52]]}
    rows = [(k, "\n".join(held), "en", "s", 0) for k, held in texts.items()]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs, DATA).collect()}
    assert found == {1: rows[0][1], 3: "\n".join(lines[41:46]), 4: f"{lines[50]}\n{lines[51]}", 5: lines[52]}


def test_similar_stage_against_brute_force(staged):
    texts = {r.doc_id: r.text for r in staged[2].collect()}
    wanted = {component for _, component in brute(texts, 5, 80).values()}
    assert sorted(r.doc_id for r in staged[3].collect()) == sorted(wanted)
    assert len(wanted) < len(texts)


def test_packing_stage_against_the_library(staged):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in staged[3].collect()}
    found, windows = {}, {}
    for row in staged[4].collect():
        found.setdefault(row.doc_id, {})[row.start] = row
        windows.setdefault(row.sequence_id, []).append((row.offset, row.length))
    assert set(found) == set(texts)
    for key, pieces in found.items():
        ids = np.array(library.encode(texts[key], add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for start in sorted(pieces):
            row = pieces[start]
            assert start == at and row.doc_tokens == len(ids)
            assert row.ids_crc32 == zlib.crc32(ids[start : start + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_gives_the_last_stage(spark, staged):
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert {(r.doc_id, r.start) for r in rows if r.start == 0} == {
        (r.doc_id, 0) for r in staged[4].collect() if r.start == 0
    }


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages_on_odd_documents(spark, tmp_path, rows):
    line = "a line that is long enough to be compared"
    odd = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "12 !!", "en", "s", 1),
           (4, f"{line}\nthe rest of four", "en", "s", 2), (4, f"{line}\nthe rest of four", "en", "s", 2),
           (5, f"{line}\nthe rest of five", "en", "s", 2), (6, line, None, "s", 3), (None, "no id at all", "en", "s", 1),
           (7, "word " * 100_000, "en", "s", 9)]
    more = ", score string, n_lines string, tile string"
    given = [(*r, f"s{r[0]}", "l", "t") for r in odd if rows == "odd"]
    docs = spark.createDataFrame(given, SCHEMA + more)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        if number:
            docs = spark.read.parquet(f"{tmp_path}/{number - 1}")
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{number}")
        if number < 3:
            kept = spark.read.parquet(f"{tmp_path}/{number}")
            assert kept.columns == docs.columns
            assert all(r.score == f"s{r.doc_id}" and r.n_lines == "l" for r in kept.collect())
    found = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/3").collect()}
    assert found == ({4, 5, None, 7} if rows == "odd" else set())
