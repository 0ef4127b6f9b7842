"""Readers, envelope parsing, page extraction and the streaming landing."""

import json
import os

from pyspark.sql import functions as F

from jobstar import schemas
from jobstar.functions import html as H
from jobstar.operators.board import board_cards, board_detail
from jobstar.operators.pages import cards, envelope_rows, links_indexed, split_head
from jobstar.sources.readers import read_envelopes, read_json_records
from jobstar.streaming.ingest import land_stream
from tests.helpers import posting_a, posting_b, write_json_array

DETAIL = """<html><head><script>var t="</div>";</script></head><body>
<div class="job-detail__info--sections">
 <div><div class="job-detail__info--section-content-value">10 - 20 triệu</div></div>
 <div><div class="job-detail__info--section-content-value">Hà Nội</div></div>
 <div><div class="job-detail__info--section-content-value">3 năm</div></div>
</div>
<div class="job-detail__info--deadline">Hạn nộp hồ sơ: 30/08/2025</div>
<h3>Mô tả công việc</h3><div>Build &amp; run pipelines</div>
<h3>Yêu cầu ứng viên</h3><div><p>Python</p><p>SQL</p></div>
<div class="company-scale"><div>Quy mô:</div><div class="company-value">100-499 nhân viên</div></div>
</body></html>"""


def test_board_detail(spark):
    shifted = DETAIL.replace('<div class="job-detail__info--section-content-value">10 - 20 triệu</div>', "")
    nested = DETAIL.replace("<p>Python</p>", "<div><div>Python</div></div></i>")
    df = spark.createDataFrame([(1, DETAIL), (2, "<html></html>"), (3, shifted), (4, nested), (5, None), (6, "<div <p")],
                               "id int, html string")
    rows = {r.id: r for r in board_detail(df, ["id"]).collect()}
    assert (rows[3].salary, rows[3].city, rows[3].yoe) == (None, "Hà Nội", "3 năm")
    assert rows[4].requirements == "Python SQL"
    assert all(rows[i].skills == [] and rows[i].salary is None for i in (2, 5, 6))
    r = rows[1]
    assert (r.salary, r.city, r.yoe) == ("10 - 20 triệu", "Hà Nội", "3 năm")
    assert r.deadline_submit == "Hạn nộp hồ sơ: 30/08/2025"
    assert r.description == "Build & run pipelines" and r.requirements == "Python SQL"
    assert r.company_size == "100-499 nhân viên" and r.work_address is None
    empty = rows[2]
    assert all(empty[c] is None for c in ["salary", "city", "yoe", "description", "company_size"])


def test_board_cards_skip_incomplete(spark):
    card = ('<div class="box-header"><h3><a href="/{0}"><span>T{0}</span></a></h3><a class="company">C</a>'
            '<label class="deadline">d</label><div class="label-content"><label class="address">HN</label>{1}</div></div>')
    html = card.format(1, '<label class="time">t</label>') + card.format(2, "") + card.format(3, '<label class="time">u</label>')
    df = spark.createDataFrame([(7, html), (8, None)], "id int, html string")
    assert [tuple(r) for r in board_cards(df, ["id"]).collect()] == [
        (7, 0, "/1", "T1", "C", "d", "HN", "t"), (7, 1, "/3", "T3", "C", "d", "HN", "u")]


def test_cards_links_and_split(spark):
    html = ('<ul><li><a href="/a">A</a></li><li><a href="">B</a></li><li><span>x</span></li>'
            '<li><a href="/c">C &amp; D</a></li></ul><a>no target</a>')
    df = spark.createDataFrame([(7, html)], "id int, html string")
    got = [tuple(r) for r in cards(df, "id", "html", r"(?is)<li\b[^>]*>(.*?)</li>",
                                   {"href": r'href="([^"]*)"', "label": r"<a\b[^>]*>(.*?)</a>"}).collect()]
    assert got == [(7, 0, "/a", "A"), (7, 3, "/c", "C & D")]
    links = [tuple(r) for r in links_indexed(df, "id", "html").collect()]
    assert links == [(7, 0, "/a"), (7, 2, "/c")]      # index of the 4 anchors kept
    arr = spark.createDataFrame([(["s1", "s2", "a1"], ["a1"]), (["x"], ["y", "z"])], "a array<string>, b array<string>")
    assert [r[0] for r in arr.select(split_head("a", "b")).collect()] == [["s1", "s2"], []]


def test_paragraphs_and_count(spark):
    df = spark.createDataFrame([("<article><h1>T</h1><p><b>one</b><br><p>two</p><p> </p></article>",
                                 "1.234 việc làm")], "html string, t string")
    r = df.select(H.paragraphs(F.regexp_extract("html", "(?is)<article>(.*?)</article>", 1)),
                  H.count_from_text("t")).first()
    assert r[0] == ["one", "two"] and r[1] == 1234


def test_read_json_array_files(spark, tmp_root):
    write_json_array(os.path.join(tmp_root, "a", "1.json"), [posting_a(), posting_a(id="1")])
    write_json_array(os.path.join(tmp_root, "a", "2.json"), [posting_a(id="2")])
    df = read_json_records(spark, os.path.join(tmp_root, "a"), schemas.BRONZE_A, with_file=True)
    assert df.count() == 3 and df.select("source_file").distinct().count() == 2


def test_envelopes(spark, tmp_root):
    d = os.path.join(tmp_root, "env")
    os.makedirs(d)
    with open(os.path.join(d, "p0.json"), "w") as f:
        json.dump({"data": [posting_b(), posting_b(jobTitle="X")], "meta": {"nbPages": 2}}, f)
    with open(os.path.join(d, "p1.json"), "w") as f:
        json.dump({"data": [posting_b(jobTitle="Y")]}, f)
    with open(os.path.join(d, "p2.json"), "w") as f:
        json.dump({"meta": {"nbPages": 2}}, f)
    rows = envelope_rows(read_envelopes(spark, d, schemas.ENVELOPE_B)).select("jobTitle", "nb_pages").collect()
    assert sorted(tuple(r) for r in rows) == [("Data Engineer", 2), ("X", 2), ("Y", 0)]


def test_stream_landing_is_incremental(spark, tmp_root):
    src = os.path.join(tmp_root, "in")
    out = os.path.join(tmp_root, "bronze")
    ckpt = os.path.join(tmp_root, "ckpt")
    write_json_array(os.path.join(src, "1.json"), [posting_a(), posting_a(id="1")])
    land_stream(spark, src, schemas.BRONZE_A, out, ckpt, source="topcv")
    assert spark.read.parquet(out).count() == 2
    write_json_array(os.path.join(src, "2.json"), [posting_a(id="2")])
    land_stream(spark, src, schemas.BRONZE_A, out, ckpt, source="topcv")   # only the new file
    landed = spark.read.parquet(out)
    assert landed.count() == 3 and landed.select("id").distinct().count() == 3


def test_board_bronze_broadcasts_no_detail_pages(spark):
    """Spark takes rows out of Python for small ones, so it would pass all detail pages through the driver."""
    from jobstar.operators.board import CARD_FIELDS, LIST_FIELDS, TEXT_FIELDS, board_bronze
    cards = spark.createDataFrame([("u1", *"abcde"), ("u2", *"fghij")], ", ".join(f"{c} string" for c in CARD_FIELDS))
    detail = spark.createDataFrame([("u1", *["t"] * len(TEXT_FIELDS), *[["l"]] * len(LIST_FIELDS))], ", ".join(
        ["href string", *(f"{c} string" for c in TEXT_FIELDS), *(f"{c} array<string>" for c in LIST_FIELDS)]))
    out = board_bronze(cards, detail)
    assert [(r.title, r.salary, r.skills) for r in out.collect()] == [("a", "t", ["l"])]
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
