"""The pipeline, stage by stage, against brute force on what each stage was given."""

import hashlib

import duckdb
import numpy as np
import sentencepiece

import __spark_entry__ as contract
import corpus_pipeline
from delaycast.llm import string_tiling as st
from delaycast.llm.line_dedup import oracle
from delaycast.llm.queries import LINE_DEDUP, tokenizer_path
from tests.llm.test_simhash import plain_fingerprint, roots_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, folder):
    sf_dir = contract.SMOKE_DIR.replace("0.001", "0.01")
    docs, results = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, sf_dir)
        assert found.columns == COLUMNS or number == len(corpus_pipeline.STAGES) - 1
        found.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        results.append({r.doc_id: r for r in docs.collect()})
    good, lines, single, clean, encoded = results

    # Quality: labelled documents are kept or dropped as their label says, with few exceptions.
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert np.mean([(i in good) == bool(q) for i, q in labels.items()]) > 0.95
    assert np.mean([i in good for i, q in labels.items() if q]) > 0.98

    # Line dedup: the oracle on the stage's own input.
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/quality_classifier/*.parquet'")
    expected = {r[0]: r[1] for r in connection.execute(f"SELECT doc_id, text FROM ({oracle(LINE_DEDUP.min_words)})").fetchall()}
    assert {i: r.text for i, r in lines.items()} == expected and set(lines) == set(good)
    assert all(r.n_chars == len(r.text) for i, r in lines.items() if r.text != good[i].text)

    # SimHash: the smallest id of each component.
    ids = sorted(lines)
    roots = roots_of([plain_fingerprint(lines[i].text) for i in ids], 3)
    assert set(single) == {i for at, i in enumerate(ids) if roots[at] == at}

    # Decontamination: no document that leaks an item stays, all others do.
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    grams = []
    for _, text in items:
        own = st.tokens(text)
        grams.append((own, {tuple(own[k : k + 5]) for k in range(len(own) - 4)}))
    for i, row in single.items():
        own = st.tokens(row.text)
        seen = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
        near = [item for item, g in grams if len(g & seen) * 5 >= 0.5 * len(item)]
        leaked = any(sum(n for *_, n in st.tile([abs(hash(t)) for t in item], [abs(hash(t)) for t in own], 5)) >= 0.5 * len(item) for item in near)
        assert (i in clean) == (not leaked)
    assert len(clean) < len(single) < len(lines) < 1000

    # Encoding: as the library does.
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    assert set(encoded) == set(clean)
    for i, row in encoded.items():
        ids = library.encode(clean[i].text, add_bos=True, add_eos=True)
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_query_runs_all_stages(spark):
    found = contract.queries()["pipeline"](spark, contract.SMOKE_DIR)
    assert {"doc_id", "ids", "n_tokens"} <= set(found.columns) and 0 < found.count() < 200


EDGE_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, gone string, _gone int, _doc int, _kept int, _removed int, _digests int, ids string, fp int, label int, weight int"


def edge_rows():
    line = "one two three four five six seven eight nine"
    texts = [None, "", "\n\n", line, f"{line}\n{line}", f"own words here\n{line}", "word " * 60_000, "x" * 200_000, f"own words here\n{line}", "Ünï ▁ 中文\x00"]
    rows = [(i, t, None if i % 2 else "en", None, None if i % 3 else 7) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, line, None, None, None), (None, None, None, None, None)]
    return [(*r, 0.5, "g", 1, 2, 3, 4, 5, "i", 6, 1, 9) for r in rows]


def test_stages_on_edge_rows_and_empty_tables(spark, folder):
    labels = [(i, int(i < 8), 0) for i in range(10)] + [(None, 1, None), (3, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, "one two three four five six seven eight nine ten eleven"), (None, "a"), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = edge_rows()
    docs = spark.createDataFrame(rows, EDGE_COLUMNS)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, folder)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert found.columns == docs.columns
        result = found.collect()
        assert len(result) <= len(rows)
        if number == 1:
            kept = sorted((str(r.doc_id), r.text or "", r._gone) for r in result)
            assert len(kept) == len(rows) and ("5", "own words here", 1) in kept and ("8", "own words here", 1) not in kept
            assert [t for i, t, _ in kept if i == "None"] == ["", rows[3][1]]
        if number == 2:
            assert {r.doc_id for r in result} >= {0, 3, 6, 7, 9} and not {1, 2, 8} & {r.doc_id for r in result}
        if number == 3:
            assert {r.doc_id for r in result} == {0, 1, 2, 6, 7, 9, None}
        if number == 4:
            assert len(result) == len(rows) and all(r.ids[0] == 1 and r.ids[-1] == 2 and r._digests == 5 for r in result)
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_nothing_goes_without_two_classes(spark, folder):
    docs = spark.createDataFrame(edge_rows(), EDGE_COLUMNS)
    for name, labels in (("none", []), ("good", [(i, 1, 0) for i in range(10)]), ("bad", [(i, 0, 0) for i in range(10)]),
                         ("unknown", [(i, i % 2 + 5, 0) for i in range(10)])):
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/{name}/labels.parquet")
        kept = corpus_pipeline.keep_good(spark, docs, f"{folder}/{name}")
        assert kept.columns == docs.columns and kept.count() == docs.count()
