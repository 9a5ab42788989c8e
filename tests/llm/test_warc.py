"""Archives: exact round trip, roles against brute force, and salvage of damaged files."""

import base64
import gzip
import hashlib
import random

import pytest

pytest.importorskip("terrace.llm")

from terrace.llm import warc  # noqa: E402
from terrace.llm.tables import ship_package  # noqa: E402

SCHEMA = "page_id long, url string, html string, digest string, copies int, rows int, top string, copy string"


def base32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages():
    chance = random.Random(3)
    texts = ["", None, "same", "täglich 😀", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "a" * 300_000, "\x1f\x8b\x08 no member", "line\r\n\r\nend\r\n\r\n"]
    out = [(i, f"http://h.example/{i}", chance.choice(texts)) for i in range(120)]
    out += [(i, f"http://h.example/ü {i}\r\nX: y", f"own text {i}") for i in range(120, 160)]
    out += [out[7], out[7], out[130], (None, None, "no id"), (None, "http://u.example", "same"), (5, "http://other.example", "same"), (-4, None, "minus")]
    return [(*r, "x", 1, 2, "t", "c") for r in out]


def wanted(pages):
    """(page_id, bytes, digest, type, refers_to) of every record, by sorting each group of equal payloads."""
    out, groups = [], {}
    for page, url, html, *_ in pages:
        groups.setdefault(html or "", []).append((page is not None, page or 0, url is not None, url or "", page))
    for html, rows in groups.items():
        rows.sort(reverse=True)
        for place, row in enumerate(rows):
            out.append((row[-1], len(html.encode()), base32(html), "revisit" if place else "response", rows[0][-1] if place else None))
    return sorted(out, key=str)


def test_records_come_back_as_they_went_in(spark, pages, tmp_path):
    ship_package(spark)
    df = spark.createDataFrame(pages, SCHEMA).repartition(4)
    warc.write_archives(df, f"{tmp_path}/a", file_records=50)
    read = warc.read_archives(spark, f"{tmp_path}/a")
    rows = warc.records(read).collect()
    assert warc.gaps(read).count() == 0
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == wanted(pages)
    texts = {(p[0], p[2] or "") for p in pages}
    for r in rows:
        if r.record_type == "response":
            assert (r.page_id, bytes(r.payload).decode()) in texts
    assert len({r.record_id for r in rows}) == len(rows)
    files = [f for f in (tmp_path / "a").iterdir() if f.name.startswith("part-")]
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in files)  # plain gzip reads them too
    assert whole.count(b"WARC-Record-ID: ") == len(rows) and len({r.file for r in rows}) >= len(rows) // 50


def test_no_pages_no_records(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], SCHEMA), f"{tmp_path}/e")
    assert warc.read_archives(spark, f"{tmp_path}/e").count() == 0


def made(n, kind):
    out = []
    for i in range(n):
        html = f"page {i} " + "text " * (i % 7)
        one = warc.record(i, f"http://h.example/{i}", base32(html), len(html), html.encode())
        out.append(warc._gzip(one) if kind == "gzip" else one)
    return out


@pytest.mark.parametrize("kind", ["gzip", "plain"])
def test_salvage_after_each_kind_of_damage(kind):
    chance = random.Random(8)
    for trial in range(60):
        parts = made(12, kind)
        broken = set(chance.sample(range(12), 3))
        for i in broken:
            p = parts[i]
            at = chance.randrange(len(p) - 1)
            how = trial % 4
            parts[i] = (
                p[:at] + bytes([p[at] ^ 0x55]) + p[at + 1 :] if how == 0 else p[: max(1, at)] if how == 1 else b"junk " * 9 + p if how == 2 else chance.randbytes(len(p))
            )
        starts = [sum(map(len, parts[:i])) for i in range(13)]
        rows = list(warc.salvage(b"".join(parts)))
        ids = [r[5] for r in rows if r[2] is None]
        whole = [i for i in range(12) if i not in broken or trial % 4 == 2]
        assert set(whole) <= set(ids) and len(ids) == len(set(ids))
        covered = 0
        for start, end, *_ in rows:  # every byte is in one record or one gap, in order
            assert start == covered and end > start
            covered = end
        assert covered == starts[-1]
        for start, end, gap, *rest in rows:
            if gap is not None:
                assert any(start < starts[i + 1] and end > starts[i] for i in broken)


def test_checks_name_what_failed():
    one = made(1, "plain")[0]
    reason = lambda data: [r[2] for r in warc.salvage(data)]
    assert reason(one) == [None] and reason(b"") == []
    assert reason(one.replace(b"page 0", b"pagE 0")) == ["block digest"]
    assert reason(one[:-2]) == ["the block does not end where its length says"]
    assert reason(b"garbage") == ["no version line"]
    assert reason(warc._gzip(one)[:-3]) == ["gzip: the member does not end"]
    assert reason(b"x" + one + b"yy" + warc._gzip(one)) == ["no version line", None, "no version line", None]
    swapped = one.replace(base32("page 0 ").encode(), b"A" * 32)
    assert reason(swapped) == ["payload digest"]


def test_damaged_files_in_spark(spark, tmp_path):
    ship_package(spark)
    (tmp_path / "w").mkdir()
    parts = made(20, "gzip")
    (tmp_path / "w" / "one.warc.gz").write_bytes(b"".join(parts[:10]) + b"\0" * 777 + b"".join(parts[10:]))
    (tmp_path / "w" / "two.warc").write_bytes(b"".join(made(5, "plain")) + b"WARC/1.1\r\ncut")
    read = warc.read_archives(spark, f"{tmp_path}/w").cache()
    assert sorted(r.page_id for r in warc.records(read).collect()) == sorted([*range(20), *range(5)])
    start = sum(map(len, parts[:10]))
    found = sorted((r.file.rsplit("/", 1)[1], r.start, r.end, r.gap) for r in warc.gaps(read).collect())
    assert found[0][:3] == ("one.warc.gz", start, start + 777) and found[1][0] == "two.warc" and found[1][3] == "the header does not end"
