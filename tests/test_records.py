"""Records over many small splits against Python's csv module."""

from __future__ import annotations

import csv
import io
import os
import random

import pytest

from aerolap.schema import RAW_HEADER_NAMES
from aerolap.sources.csv import read_raw, typed_from_fields
from aerolap.sources.records import records


@pytest.fixture()
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "150b", "spark.sql.files.openCostInBytes": "1b"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def by_file(df):
    out = {}
    for r in df.collect():
        out.setdefault(os.path.basename(r.file), []).append((r.number, r.value))
    return {f: sorted(v) for f, v in out.items()}


def test_random_files(spark, tmp_dir, tiny_splits):
    rng = random.Random(8)
    want = {}
    for n in range(4):
        field = lambda: "".join(rng.choice(["a", '"', ",", "\n", "\r\n", "é", " "]) for _ in range(rng.randint(0, 9)))
        rows = [[field() for _ in range(3)] for _ in range(70)]
        text = io.StringIO(newline="")
        csv.writer(text, lineterminator="\r\n" if n % 2 else "\n").writerows(rows)
        with open(f"{tmp_dir}/{n}.csv", "wb") as f:
            f.write((b"\xef\xbb\xbf" if n > 1 else b"") + text.getvalue().encode())
        want[f"{n}.csv"] = rows
    got = by_file(records(spark, tmp_dir))
    for name, rows in want.items():
        assert [n for n, _ in got[name]] == list(range(1, len(rows) + 1))
        assert [next(csv.reader(io.StringIO(v, newline=""))) for _, v in got[name]] == rows


def test_quotes_inside_unquoted_fields_open_nothing(spark, tmp_dir, tiny_splits):
    lines = ['a,5" pipe,b', '"x"y"z,1', 'plain', '', '"",""', 'a,"b""', 'c",d']
    with open(f"{tmp_dir}/q.csv", "w") as f:
        f.write("\n".join(lines * 12) + "\n")
    got = [v for _, v in by_file(records(spark, tmp_dir))["q.csv"]]
    assert got == [*lines[:5], 'a,"b""\nc",d'] * 12


def test_a_quote_that_is_never_closed(spark, tmp_dir, tiny_splits):
    with open(f"{tmp_dir}/q.csv", "w") as f:
        f.write('head\n"open\n' + "line\n" * 60)
    open(f"{tmp_dir}/empty.csv", "w").close()
    got = by_file(records(spark, tmp_dir, max_lines=20))["q.csv"]
    assert got == [(1, "head"), (2, '"open')] + [(2, "line")] * 60
    assert by_file(records(spark, tmp_dir))["q.csv"] == [(1, "head"), (2, '"open' + "\nline" * 60)]


def test_raw_files_with_a_mark_and_rows_like_the_header(spark, tmp_dir, tiny_splits):
    row = ["AA", "ORD", "LAX", "5.00", "7.00", "0930", "2008", "1", "2", "3", "19805"]
    for name, mark in (("a.csv", b""), ("b.csv", b"\xef\xbb\xbf")):
        text = io.StringIO(newline="")
        w = csv.writer(text)
        w.writerows([["Note", *RAW_HEADER_NAMES], ["two\nlines, \"quoted\"", *row], ["Note", *RAW_HEADER_NAMES]])
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(mark + text.getvalue().encode())
    open(f"{tmp_dir}/none.csv", "w").close()
    got = sorted((r.origin, r.reject_reason) for r in typed_from_fields(read_raw(spark, tmp_dir)).collect())
    assert got == [("ORD", None)] * 2 + [("Origin", "bad number")] * 2


def test_records_within_a_block_are_not_shuffled(spark, tmp_dir):
    with open(f"{tmp_dir}/n.csv", "w") as f:
        f.write("head,note\n" + 'a,"two\nlines"\nb,plain\n' * 500)
    df = records(spark, tmp_dir)
    assert "Exchange hashpartitioning(file" not in df._jdf.queryExecution().executedPlan().toString().split("Broadcast")[0]
    got = by_file(df)["n.csv"]
    assert got == [(1, "head,note")] + [(n + 2, 'a,"two\nlines"' if n % 2 == 0 else "b,plain") for n in range(1000)]


def test_long_records_amid_short_ones(spark, tmp_dir, tiny_splits):
    """Records longer than ``max_lines`` are given by line, in one block or not."""
    rng = random.Random(3)
    text, want = "", []
    for n in range(1, 120):
        lines = rng.choice([1, 2, 5, 6, 7, 30])
        record = [f"{n}"] if lines == 1 else ['"a', *(["x"] * (lines - 2)), f'{n}"']
        text += "".join(f"{x}\n" for x in record)
        want += [(n, x) for x in record] if lines > 6 else [(n, "\n".join(record))]
    with open(f"{tmp_dir}/l.csv", "w") as f:
        f.write(text)
    assert by_file(records(spark, tmp_dir, max_lines=6))["l.csv"] == sorted(want)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10m")
    assert by_file(records(spark, tmp_dir, max_lines=6))["l.csv"] == sorted(want)


def test_raw_text_lies_on_disk_a_piece_at_a_time(spark, tmp_dir, monkeypatch):
    """The registered query gives the rows of one whole read, whatever the size of
    a piece, and holds the text of one piece."""
    import glob
    import uuid
    from collections import Counter

    import __spark_entry__ as E
    from aerolap.plans import registry_io
    from conftest import SF_SMALL

    texts = []

    def read_raw(spark, path, read=registry_io.C.read_raw):
        files = glob.glob(f"{tmp_dir}/raw-*/**/*.csv", recursive=True)
        assert {f.split("/")[-2] for f in files} == {"plain", "marked"}
        texts.append(sum(map(os.path.getsize, files)))
        return read(spark, path)

    monkeypatch.setattr(registry_io, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}-{uuid.uuid4().hex}")
    monkeypatch.setattr(registry_io.C, "read_raw", read_raw)
    run = lambda: Counter(map(tuple, E.queries()["op_csv_multiline"](spark, SF_SMALL).collect()))
    whole = run()
    one, texts[:] = texts[0], []
    for f in glob.glob(f"{tmp_dir}/raw-*/**/*.csv", recursive=True):
        os.remove(f)
    monkeypatch.setattr(registry_io, "PIECE_ROWS", 1600)
    assert run() == whole and sum(whole.values()) % 2 == 0
    assert len(texts) >= 3 and max(texts) < one / 2
    assert not glob.glob(f"{tmp_dir}/fields-*")
