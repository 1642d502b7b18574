"""Deleted lines and suffix ranks against brute force."""

import random

import duckdb
import pytest

import __spark_entry__ as contract
from delaycast.llm import line_dedup as ld
from delaycast.llm.queries import LINE_DEDUP


def words_of(line):
    return 1 + line.count(" ")


def plain_deleted(docs, min_words):
    """{doc: deleted line numbers}: every run of enough words that starts earlier somewhere, of any length."""
    places = [(d, at) for d, lines in docs for at in range(len(lines))]
    content = dict(docs)
    gone = {d: set() for d, _ in docs}
    for number, (d, at) in enumerate(places):
        for e, start in places[:number]:
            size = 0
            a, b = content[d], content[e]
            while at + size < len(a) and start + size < len(b) and a[at + size] == b[start + size]:
                size += 1
            if sum(words_of(x) for x in a[at : at + size]) >= min_words:
                gone[d].update(range(at, at + size))
    return gone


def made_up(chance, count, longest):
    lines = ["", "a", "b c", "d e f", "one two three four", "five six seven eight nine", "x y", "z", "only " * 9]
    return [(i, [chance.choice(lines) for _ in range(chance.randint(1, longest))]) for i in range(count)]


@pytest.mark.parametrize("min_words", [1, 5, 8])
def test_deleted_lines_equal_brute_force(spark, min_words):
    docs = made_up(random.Random(min_words), 25, 14)
    docs.append((90, docs[3][1] * 3))  # repeats inside one document
    df = spark.createDataFrame([(d, "\n".join(x)) for d, x in docs], "doc_id long, text string")
    expected = plain_deleted(docs, min_words)
    found = {r.doc_id: r for r in ld.dedup_lines(df, ld.LineDedupParameters(min_words), removed="n").collect()}
    assert len(found) == len(docs)
    for d, lines in docs:
        assert found[d].text == "\n".join(x for at, x in enumerate(lines) if at not in expected[d]), d
        assert found[d].n == len(expected[d])


def test_ranks_are_the_sorted_suffixes(spark):
    docs = made_up(random.Random(4), 12, 9)
    df = spark.createDataFrame([(d, "\n".join(x)) for d, x in docs], "doc_id long, text string")
    rows = ld.suffix_ranks(df, 4).collect()
    content = dict(docs)
    repeated = {x for x in sum(content.values(), []) if sum(y.count(x) for y in content.values()) > 1}
    assert len(rows) == sum(x in repeated for y in content.values() for x in y)
    order = {content[r.doc][r.at]: r.rank1 for r in rows}

    def prefix(row, k):
        out = []
        for line in content[row.doc][row.at : row.at + k]:
            if line not in repeated:
                break
            out.append(order[line])
        return out

    for k in (1, 2, 4):
        keys = sorted(prefix(r, k) for r in rows)
        assert all(r[f"rank{k}"] == keys.index(prefix(r, k)) for r in rows)


def test_edge_rows(spark):
    run = "one two three four five\nsix seven eight nine"
    rows = [(1, run, 5, "g"), (1, run, 5, "g"), (2, run + "\nown", 6, None), (3, None, None, "h"), (4, "", 0, ""),
            (5, "\n\n", 1, ""), (None, run, 7, "i"), (6, "head\n" + run, 1, "k"), (7, "\n".join([run] * 4000), 1, "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone long, at string")
    result = ld.dedup_lines(df)
    assert result.columns == df.columns
    found = sorted((str(r.doc_id), r.text, r.gone) for r in result.collect())
    expected = [("1", run, 5), ("1", run, 5), ("2", "own", 6), ("3", None, None), ("4", "", 0), ("5", "\n\n", 1),
                ("6", "head", 1), ("7", "", 1), ("None", run, 7)]
    assert found == sorted(expected, key=lambda r: (r[0], r[1]))
    assert ld.dedup_lines(df.limit(0)).count() == 0


def test_query_equals_oracle(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{contract.SMOKE_DIR}/documents.parquet'")
    sql = contract.oracle_sql()["op10_line_dedup"]
    expected = connection.execute(f"SELECT doc_id, text, n_deleted FROM ({sql})").fetchall()
    found = contract.queries()["op10_line_dedup"](spark, contract.SMOKE_DIR).collect()
    assert sorted((r.doc_id, r.text, r.n_deleted) for r in found) == sorted(expected)
    assert any(r.n_deleted for r in found)
    assert LINE_DEDUP.min_words == 8
