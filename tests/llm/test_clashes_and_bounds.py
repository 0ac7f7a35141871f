"""Columns that clash with inner names, places of lines, bounds of what is broadcast."""

import numpy as np
import pyarrow as pa
import pytest

from canonix.llm import bpe, decontaminate, lines


def test_line_places_hold_any_text():
    assert lines.place_bits(10, 0, None) == 1
    assert lines.place_bits(1 << 30, 1 << 24, None) == 25  # line 2 ** 24 of a row is before the next row
    assert lines.place_bits(1 << 40, 1 << 30, lambda: 1000) == 10
    with pytest.raises(ValueError, match="places"):
        lines.place_bits(1 << 50, 1 << 30, lambda: 1 << 20)


def test_line_places_in_order(spark):
    bits = lines.place_bits(2, 1 << 24, None)
    rows = spark.createDataFrame([(0, (1 << 24) - 1), (0, 1 << 24), (1, 0), (1, 1 << 24)], "row long, pos int")
    places = [r[0] for r in rows.select(lines._place(bits)).collect()]
    assert places == sorted(set(places))


def test_lines_keep_columns_of_inner_names(spark, tmp_path):
    path = str(tmp_path) + "/d"
    docs = spark.createDataFrame([("same line of text here\nother", 7, 8, "x", 9), ("same line of text here", 1, 2, "y", 3)],
                                 "text string, __row long, __gone int, __file string, __n_gone long")
    docs.coalesce(1).write.parquet(path)
    got = lines.dedup_lines(spark.read.parquet(path))
    assert got.columns == ["text", "__row", "__gone", "__file", "__n_lines", "__n_gone"]
    assert sorted(map(tuple, got.collect())) == [("", 1, 2, "y", 1, 1), ("same line of text here\nother", 7, 8, "x", 2, 0)]


@pytest.mark.parametrize("clash", ["n_tokens", "ids", "__text"])
def test_encoding_takes_clashing_columns(spark, clash):
    docs = spark.createDataFrame([(1, "some text", "own"), (2, None, "own")], f"doc_id long, text string, {clash} string")
    got = bpe.encode_documents(docs, keep=("doc_id", clash))
    assert got.columns == (["doc_id", clash, "n_tokens", "ids"] if clash == "__text" else ["doc_id", "n_tokens", "ids"])
    plain = bpe.encode_documents(docs, keep=("doc_id",))
    rows = {r["doc_id"]: (r["n_tokens"], bytes(r["ids"])) for r in got.collect()}
    assert rows == {r["doc_id"]: (r["n_tokens"], bytes(r["ids"])) for r in plain.collect()} and rows[2] == (0, b"")


def test_item_tables_are_a_few_times_their_text():
    text = " ".join(f"w{i % 5000}" for i in range(200_000))
    items = decontaminate.item_windows([1], pa.array([text]))
    held = items["hashes"].nbytes + sum(x.nbytes for w in items["windows"] for x in w.values() if isinstance(x, np.ndarray))
    assert held < 5 * len(text)
