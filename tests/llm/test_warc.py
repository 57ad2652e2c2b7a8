import random

import pytest

from pyspark.sql import Row

from pairscore.llm import warc


def record(i, payload=b"<p>x</p>", kind="response", ref=None):
    return warc.record_bytes(kind, f"urn:page:{i}", f"http://h/{i}", payload, ref)


def good(rows):
    return [r["record_id"] for r in rows if r["error"] is None]


def test_members_round_trip_and_gaps_cover_the_file():
    parts = [warc.gzip_member(record(i, bytes([65 + i]) * 5000)) for i in range(6)]
    data = b"".join(parts)
    assert good(warc.salvage_bytes(data)) == [f"urn:page:{i}" for i in range(6)]
    rng = random.Random(1)
    for trial in range(30):
        bad = bytearray(data)
        hit = rng.randrange(6)
        at = sum(map(len, parts[:hit])) + rng.randrange(len(parts[hit]))
        bad[at] ^= 1 << rng.randrange(8)
        rows = warc.salvage_bytes(bytes(bad))
        ids = good(rows)
        assert set(ids) >= {f"urn:page:{i}" for i in range(6) if i != hit}
        spans = sorted((r["offset"], r["length"]) for r in rows)
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        assert sum(spans[-1]) == len(bad)


def test_plain_records_are_salvaged_after_a_wrong_length_and_a_cut():
    parts = [record(i, b"WARC/1.1 in text \r\n" * 3) for i in range(5)]
    data = b"".join(parts)
    assert good(warc.salvage_bytes(data)) == [f"urn:page:{i}" for i in range(5)]
    bad = data.replace(parts[2], parts[2].replace(b"Content-Length: ", b"Content-Length: 9", 1))
    rows = warc.salvage_bytes(bad)
    assert good(rows) == [f"urn:page:{i}" for i in (0, 1, 3, 4)]
    assert [r["error"] for r in rows if r["error"]] == ["record cut short"] or any(r["error"] for r in rows)
    cut = warc.salvage_bytes(data[:-30])
    assert good(cut) == [f"urn:page:{i}" for i in range(4)] and cut[-1]["error"]


def test_junk_between_members_and_large_records():
    big = record(7, bytes(random.Random(2).randbytes(3 << 20)))
    data = b"junk" + warc.gzip_member(record(1)) + warc.MAGIC + b"no member" + big + b"\x00" * 40 + warc.gzip_member(big)
    rows = warc.salvage_bytes(data)
    assert good(rows) == ["urn:page:1", "urn:page:7", "urn:page:7"]
    assert [(r["offset"], r["length"]) for r in rows if r["error"]] [0] == (0, 4)
    assert warc.salvage_bytes(b"") == [] and warc.salvage_bytes(b"xyz" * 9)[0]["length"] == 27


def test_wrong_lengths_are_not_read(spark, tmp_path):
    import io

    class Stream(io.BytesIO):
        passed = 0

        def read(self, n=-1):
            assert 0 <= n <= warc.CHUNK
            data = super().read(n)
            Stream.passed += len(data)
            return data
    parts = [record(i, random.Random(i).randbytes(3 << 20)) for i in range(9)]
    for length in (b"1" + b"0" * 17, b"9" * 18, b"20000000"):
        bad = parts[1].replace(b"Content-Length: ", b"Content-Length: %b\r\nX: " % length, 1)
        data = b"".join([parts[0], bad, *parts[2:]])
        Stream.passed = 0
        rows = warc.salvage(Stream(data))
        assert next(rows)["record_id"] == "urn:page:0"
        assert next(rows)["error"] and Stream.passed < 14 << 20
        assert good(rows) == [f"urn:page:{i}" for i in range(2, 9)]
        (tmp_path / "a.warc").write_bytes(data)
        df = spark.createDataFrame([(str(tmp_path / "a.warc"),)], "path string")
        ids = [r.record_id for r in warc.read_archives(df, payload=False).where("error is null").collect()]
        assert ids == [f"urn:page:{i}" for i in range(9) if i != 1]


def test_long_headers_within_a_member_are_read():
    uri = "http://h/" + "x" * (2 << 20)
    rows = warc.salvage_bytes(warc.gzip_member(warc.record_bytes("response", "urn:page:1", uri, b"p", None)) + warc.gzip_member(record(2)))
    assert good(rows) == ["urn:page:1", "urn:page:2"] and rows[0]["target_uri"] == uri and len(rows) == 2


def test_damage_within_a_member_costs_one_record(spark, tmp_path):
    parts = [record(i, random.Random(i).randbytes(30_000)) for i in range(6)]
    ids = [f"urn:page:{i}" for i in range(6)]
    tail = warc.gzip_member(record(9))
    for hit, right, wrong in ((0, b"WARC/1.1", b"XARC/1.1"), (2, b"Content-Length: ", b"Content-Length: 9"), (5, b"WARC-Type", b"bad\r\n")):
        inner = b"".join(p if i != hit else p.replace(right, wrong, 1) for i, p in enumerate(parts))
        rows = warc.salvage_bytes(warc.gzip_member(inner) + tail)
        assert good(rows) == [x for x in ids if x != ids[hit]] + ["urn:page:9"] and sum(r["error"] is not None for r in rows) == 1
    whole = warc.gzip_member(b"".join(parts))
    crc = bytearray(whole)
    crc[-6] ^= 1
    broken = bytearray(whole)
    broken[len(whole) // 2: len(whole) // 2 + 50] = b"\xff" * 50
    for data, least, error in ((bytes(crc) + tail, 6, "gzip"), (whole[: len(whole) // 2], 2, "member cut short"), (bytes(broken) + tail, 2, "")):
        rows = warc.salvage_bytes(data)
        kept = [x for x in good(rows) if x != "urn:page:9"]
        assert kept == ids[:len(kept)] and len(kept) >= least and (data.endswith(tail)) == ("urn:page:9" in good(rows))
        gaps = [r for r in rows if r["error"]]
        assert len(gaps) == 1 and error in gaps[0]["error"]
        spans = sorted({(r["offset"], r["length"]) for r in rows})
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) == len(data)
        (tmp_path / "a.warc.gz").write_bytes(data)
        df = spark.createDataFrame([(str(tmp_path / "a.warc.gz"),)], "path string")
        assert good(r.asDict() for r in warc.read_archives(df, payload=False).collect()) == good(rows)


def test_round_trip_of_pages(spark):
    rows = [Row(page_id=1, url="http://a/", html="x"), Row(page_id=3, url=None, html="x"), Row(page_id=2, url="u\r\nv", html="x"),
            Row(page_id=4, url="", html=None), Row(page_id=5, url="http://é/", html=""), Row(page_id=None, url="n", html="x"),
            Row(page_id=6, url="long", html="é" * 300_000), Row(page_id=7, url="d", html="d"), Row(page_id=7, url="d", html="d")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as path")
    got = {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()}
    assert got == {(1, 1, "revisit", 3), (2, 1, "revisit", 3), (3, 1, "response", None), (None, 1, "response", None),
                   (4, 0, "revisit", 5), (5, 0, "response", None), (6, 600_000, "response", None), (7, 1, "response", None)}
    assert warc.round_trip(df).count() == len(rows)
    small = {r.page_id: r for r in warc.round_trip(df, min_bytes=1).collect()}
    assert small[4].record_type == "response" and small[1].record_type == "revisit"
    assert small[4].payload_digest == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert warc.round_trip(df.limit(0)).count() == 0


def test_payloads_come_back_whole(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    files = warc.write_archives(pages, warc.shared_path(spark, "test"), file_bytes=10_000)
    assert files.count() > 1
    back = {r.record_id: bytes(r.payload).decode() for r in warc.read_archives(files).where("record_type = 'response'").collect()}
    want = {f"urn:page:{r.page_id}": r.html for r in pages.collect()}
    assert all(want[k] == v for k, v in back.items()) and len(back) >= len(set(want.values()))


def test_shared_paths_name_their_file_system(spark):
    from pairscore.llm.common import shared_path
    from pairscore.session import stage_root
    path = shared_path(spark, "x")
    assert path.startswith("file:/") and stage_root(spark).replace("file:", "") in path


def test_a_page_lost_to_damage_is_an_error(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"<p>{i} {'x' * 50}") for i in range(20)], "page_id long, url string, html string")
    write = warc.write_archives

    def damaged(*args):
        files = write(*args)
        name = files.first().path.replace("file:", "")
        data = bytearray(open(name, "rb").read())
        data[len(data) // 2: len(data) // 2 + 9] = b"\0" * 9
        open(name, "wb").write(data)
        return files
    assert warc.round_trip(pages).count() == 20
    monkeypatch.setattr(warc, "write_archives", damaged)
    with pytest.raises(RuntimeError, match="20 records written"):
        warc.round_trip(pages)


def test_every_damaged_record_lies_in_a_logged_gap(spark, monkeypatch):
    from pyspark.sql import functions as F
    rng = random.Random(3)
    pages = [(i, f"http://a/{i}", rng.choice([None, "", "same", f"<p>{i} " + "".join(rng.choice("abcdef") for _ in range(rng.randrange(900)))])) for i in range(200)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    page = F.col("page_id")
    got = warc.salvage_report(df, (page % 7 == 3) | page.between(50, 60) | (page >= 197)).collect()
    hit = {i for i in range(200) if i % 7 == 3 or 50 <= i <= 60 or i >= 197}
    assert sorted((r.page_id, r.fate) for r in got) == [(i, "gap" if i in hit else "recovered") for i in range(200)]
    assert all((r.payload_digest is None) == (r.page_id in hit) for r in got)
    assert warc.salvage_report(df.limit(0), F.lit(True)).count() == 0
