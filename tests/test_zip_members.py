"""Archives by member, and what cannot be read."""

from __future__ import annotations

import io
import os
import zipfile

from aerolap.schema import RAW_HEADER_NAMES
from aerolap.sources.csv import accepted, typed_from_fields
from aerolap.sources.files import deal_members, plan_members, quarantined, read_zipped

HEAD = ",".join(RAW_HEADER_NAMES)


def csv_text(n, at="ORD", head=HEAD):
    return "\r\n".join([head] + [f"AA,{at},LAX,5.00,7.00,0930,2008,1,2,3,{i}" for i in range(n)]) + "\r\n"


def archive(path, members, mode=zipfile.ZIP_DEFLATED):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", mode) as zf:
        for name, text in members.items():
            zf.writestr(name, text)


def test_all_that_can_be_read_is_read(spark, tmp_dir):
    archive(f"{tmp_dir}/a/good.zip", {"x/1.csv": csv_text(5), "2.csv": "﻿" + csv_text(4, "JFK"), "empty.csv": "",
                                      "note.txt": "no", "3.concise.csv": "no", "dir/": ""})
    archive(f"{tmp_dir}/b/none.zip", {})
    open(f"{tmp_dir}/b/zero.zip", "w").close()
    archive(f"{tmp_dir}/b/whole.zip", {"1.csv": csv_text(50)})
    data = open(f"{tmp_dir}/b/whole.zip", "rb").read()
    open(f"{tmp_dir}/b/cut.zip", "wb").write(data[: len(data) // 2])
    # stored members: bytes are changed in place, the checksum no longer fits
    archive(f"{tmp_dir}/c/bad.zip", {"ok.csv": csv_text(3, "SEA"), "bad.csv": csv_text(6, "BOS")}, zipfile.ZIP_STORED)
    data = bytearray(open(f"{tmp_dir}/c/bad.zip", "rb").read())
    data[data.index(b"BOS") + 1] = ord("X")
    open(f"{tmp_dir}/c/bad.zip", "wb").write(data)

    rows = read_zipped(spark, tmp_dir)
    counts = {r.origin: r["count"] for r in accepted(typed_from_fields(rows)).groupBy("origin").count().collect()}
    assert counts["ORD"] == 55 and counts["JFK"] == 4 and counts["SEA"] == 3
    faults = {(os.path.basename(r.archive), r.member): r.fault.split(":")[0] for r in quarantined(rows).collect()}
    assert faults == {("zero.zip", None): "unreadable archive", ("cut.zip", None): "unreadable archive",
                      ("bad.zip", "bad.csv"): "unreadable member"}
    reasons = sorted((r.reject_reason, "bad.csv" in r.raw_line) for r in
                     typed_from_fields(rows).where("reject_reason LIKE 'unreadable%'").collect())
    assert reasons == [("unreadable archive", False)] * 2 + [("unreadable member", True)]


def test_records_span_lines_in_members(spark, tmp_dir):
    text = io.StringIO()
    text.write("Note," + HEAD + "\r\n")
    for i in range(40):
        text.write(f'"line one\r\nline ""two""\r\n\r\n",AA,ORD,LAX,5.00,7.00,0930,2008,1,2,3,{i}\r\n')
    archive(f"{tmp_dir}/n.zip", {"n.csv": text.getvalue()})
    rows = typed_from_fields(read_zipped(spark, tmp_dir, chunk_rows=7)).collect()
    assert len(rows) == 40 and all(r.reject_reason is None and r.origin == "ORD" for r in rows)


def test_members_are_dealt_largest_first(spark, tmp_dir):
    sizes = {"huge.csv": 4000, "big.csv": 1500} | {f"s{i}.csv": 10 for i in range(30)}
    archive(f"{tmp_dir}/all.zip", {n: csv_text(k) for n, k in sizes.items()})
    plan = plan_members(spark, tmp_dir)
    dealt = deal_members(plan, share=50_000)
    tasks = [[r.member for r in part] for part in dealt.rdd.glom().collect()]
    assert tasks[0] == ["huge.csv"] and tasks[1] == ["big.csv"]
    assert sorted(m for t in tasks for m in t) == sorted(sizes)


def test_an_empty_tree_has_no_members(spark, tmp_dir):
    archive(f"{tmp_dir}/none.zip", {})
    assert read_zipped(spark, tmp_dir).count() == 0


def test_a_folder_of_any_size_is_zipped_piece_by_piece(spark, tmp_dir):
    """Archives are bounded by their files' bytes and written as a stream."""
    from aerolap.plans.registry_io import _zip_folders

    for folder in ("large", "cut", "none"):
        os.makedirs(f"{tmp_dir}/raw/{folder}")
        for i in range(6):
            with open(f"{tmp_dir}/raw/{folder}/{i}.csv", "w") as f:
                f.write(csv_text(100))
    size = os.path.getsize(f"{tmp_dir}/raw/large/0.csv")
    _zip_folders(spark, f"{tmp_dir}/raw", f"{tmp_dir}/zip", archive_bytes=2 * size)
    assert sorted(os.listdir(f"{tmp_dir}/zip")) == sorted(
        x for x in os.listdir(f"{tmp_dir}/zip") if x.endswith(".zip") or x.endswith(".crc"))
    names = sorted(x for x in os.listdir(f"{tmp_dir}/zip") if x.endswith(".zip"))
    assert names == ["cut.zip", "large-1.zip", "large-2.zip", "large.zip", "none.zip"]
    assert os.path.getsize(f"{tmp_dir}/zip/none.zip") == 0
    rows = read_zipped(spark, f"{tmp_dir}/zip")
    assert accepted(typed_from_fields(rows)).count() == 600
    assert sorted(os.path.basename(r.archive) for r in quarantined(rows).collect()) == ["cut.zip", "none.zip"]
