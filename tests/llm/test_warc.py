"""Archives: round trip, copies, oversized payloads, awkward rows."""

import base64
import collections
import hashlib
import os

import pytest

from streetlake.llm import warc

SCHEMA = "page_id long, url string, html string, refers_to string, chunk int, n long"
LONG = "".join(f"paragraph {i} é 東京\r\n\r\nWARC/1.1\r\n" for i in range(4000))


def pages():
    rows = [(1, "http://a.example/x", "<p>one</p>"), (2, "http://b.example/ü?q=a b\r\nX: y", "<p>one</p>"),
            (3, None, None), (4, "", ""), (5, "http://c.example/", LONG), (6, "http://d.example/", LONG + "tail"),
            (7, "http://e.example/", LONG), (8, "http://f.example/", "\r\n\r\n"), (9, "u", "WARC/1.1\r\n\r\n"),
            (9, "u", "WARC/1.1\r\n\r\n"), (9, "u", "other text"), (None, "n", "<p>one</p>"), (None, "n", "alone"),
            (None, "n", "alone"), (10, "x", "é" * 40000), (-4, "m", "negative id"), (11, "m", "negative id")]
    return [(*r, "clash", 7, 1) for r in rows]


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def expected(rows, min_bytes=0):
    first = {}
    for i, _, html, *_ in rows:
        if i is not None and len((html or "").encode()) >= min_bytes:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html, *_ in rows:
        to = first.get(html or "") if len((html or "").encode()) >= min_bytes else None
        revisit = to is not None and to != i
        out.append((i, len((html or "").encode()), digest(html or ""), "revisit" if revisit else "response",
                    to if revisit else None))
    return collections.Counter(out)


def found(df):
    return collections.Counter(map(tuple, df.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()))


@pytest.mark.parametrize("parts,chunk,block,per_file", [(1, 1 << 16, 1 << 20, 32), (3, 1000, 3000, 1), (2, 7, 100, 2)])
@pytest.mark.parametrize("min_bytes", [0, 12])
def test_round_trip(spark, tmp_path, parts, chunk, block, per_file, min_bytes):
    rows = [r for r in pages() if chunk > 7 or len(r[2] or "") < 1000]
    path = str(tmp_path / "warc")
    warc.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(parts), path, min_bytes, chunk, block, per_file)
    assert found(warc.read_warc(spark, path)) == expected(rows, min_bytes)


def test_chunks_carry_the_payload(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_warc(spark.createDataFrame(pages(), SCHEMA).coalesce(1), path, 0, 1000, 3000, 2)
    bodies = collections.defaultdict(list)
    for r in warc.read_chunks(spark, path).where("record_type = 'response'").collect():
        assert len(r.body) <= 1000
        r.body.decode("utf-8")                  # chunks end between characters
        bodies[r.source_row].append((r.chunk, r.last, bytes(r.body)))
    whole = []
    for chunks in bodies.values():
        chunks.sort()
        assert [c[0] for c in chunks] == list(range(1, len(chunks) + 1))
        assert [c[1] for c in chunks] == [False] * (len(chunks) - 1) + [True]
        whole.append(b"".join(c[2] for c in chunks).decode())
    # continuation records name no type of their own: all that is a response comes back whole
    want = [r[2] or "" for r, kind in zip(pages(), kinds(pages())) if kind == "response"]
    assert collections.Counter(whole) == collections.Counter(want)


def kinds(rows):
    first = {}
    for i, _, html, *_ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    return ["revisit" if first.get(r[2] or "", r[0]) != r[0] else "response" for r in rows]


def test_damage_is_noticed(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_warc(spark.createDataFrame(pages(), SCHEMA).coalesce(1), path, 0, 1000, 3000, 2)
    name = next(os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("part"))
    with open(name, "rb") as f:
        data = f.read()
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
    at = data.index(b"<p>one")
    with pytest.raises(ValueError, match="does not match"):
        for head, _, part in warc.parse(data[:at] + b"<P>one" + data[at + 6:]):
            if head["WARC-Type"] == "response":
                assert_digest(head, part)
    with pytest.raises(ValueError, match="cut short"):
        list(warc.parse(data[:-3]))


def assert_digest(head, part):
    if "WARC-Segment-Number" not in head and warc.base32(hashlib.sha1(part)) != head["WARC-Payload-Digest"][5:]:
        raise ValueError("does not match")


def test_many_groups_of_copies(spark):
    """Beyond the broadcast bound the heavy groups are broadcast and the rest shuffled."""
    from streetlake.llm.common import attach_groups
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL "
                                        "ELSE CAST(id % 600 AS STRING) END AS k")
    groups = rows.where("k IS NOT NULL").groupBy("k").count().withColumnRenamed("count", "n").where("n > 1")
    want = found_rows(attach_groups(rows, groups, "k", "n"))
    assert found_rows(attach_groups(rows, groups, "k", "n", max_rows=10)) == want
    assert len(want) == 5000


def found_rows(df):
    return sorted(df.select("id", "k", "n").collect(), key=lambda r: r.id)


def test_empty(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_warc(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_warc(spark, path).count() == 0
