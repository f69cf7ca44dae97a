"""Archives written and read back, by plain Python's own rules and with damaged bytes."""

import base64
import gzip
import hashlib
import io
import random
import zlib

from tidegate.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, first long, row string"


def page_rows():
    rnd = random.Random(3)
    texts = [None, "", "<p>é\r\n\r\nWARC/1.1\r\n\r\n", "x" * 3_000_000, *["".join(rnd.choice("abc é\r\n") for _ in range(rnd.randint(1, 400))) for _ in range(40)]]
    rows = [(k if k % 9 else None, f"http://h/{k}\r\nX: é" if k % 5 else None, t, "p", 1, "r") for k, t in enumerate(texts)]
    rows += [(100 + k, "http://same", texts[5], "p", 1, "r") for k in range(30)] + [rows[7], rows[7], rows[0], (-4, "u", texts[8], "p", 1, "r")]
    rnd.shuffle(rows)
    return rows


def expected(rows, least=0):
    out = []
    for text in {r[2] or "" for r in rows}:
        data = text.encode()
        same = sorted((r for r in rows if (r[2] or "") == text), key=lambda r: (r[0] is None, r[0] or 0))
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        for k, r in enumerate(same):
            revisit = k > 0 and len(data) >= least
            out.append((r[0], len(data), digest, "revisit" if revisit else "response", same[0][0] if revisit else None, None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, warc.round_trip(pages).collect()), key=repr) == expected(rows)
    assert sorted(map(tuple, warc.round_trip(pages, 100, 2000).collect()), key=repr) == expected(rows, 100)
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_archives_are_gzip_members_with_payloads(spark, tmp_path):
    rows = page_rows()
    archives = warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path / "a b"), 0, 5_000)
    found = warc.read_archives(archives).where("record_type <> 'warcinfo'")
    assert {bytes(r["payload"]).decode() for r in found.where("record_type = 'response'").collect()} == {r[2] or "" for r in rows}
    assert found.where("error IS NOT NULL").count() == 0 and found.count() == len(rows)
    assert {r["uri"] for r in found.collect() if r["uri"] and "/" in r["uri"][7:]} == {f"http://h/{k}%0D%0AX:%20é" for k in range(44) if k % 5}
    listed = archives.collect()
    assert len(listed) > 3 and sum(r["n_records"] for r in listed) == len(rows)
    for r in listed:
        data = open(r["archive"].removeprefix("file:"), "rb").read()
        assert len(data) == r["n_bytes"] and gzip.decompress(data).count(b"WARC-Type: ") == r["n_records"] + 1


def read(data):
    return list(warc.records(io.BytesIO(data), "a", True))


def member(name, payload, length=None, digest=None):
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: {name}\r\n"
    if digest:
        head += f"WARC-Payload-Digest: sha1:{digest}\r\n"
    data = head.encode() + f"Content-Length: {len(payload) if length is None else length}\r\n\r\n".encode() + payload + b"\r\n\r\n"
    return gzip.compress(data)


def test_damaged_records_are_told_and_the_others_read():
    rnd = random.Random(1)
    good = [member(f"g{k}", rnd.randbytes(n)) for k, n in enumerate((0, 10, 600_000, 70_000))]
    bad = {
        "short": member("short", b"abc", 9), "long": member("long", b"abcdef", 3), "none": member("none", b"x", "-1"),
        "digest": member("digest", b"abc", None, "A" * 32), "other": gzip.compress(b"nothing\r\n\r\n"), "endless": gzip.compress(b"WARC/1.1\r\n" + b"a" * 2_000_000),
    }
    data, places = b"", {}
    for k, (name, m) in enumerate(bad.items()):
        places[len(data)] = name
        data += m + good[k % 4]
    rows = read(data)
    assert [r[1] for r in rows if r[10]] == list(places) and len(rows) == 2 * len(bad)
    assert [r[2] for r in rows if not r[10]] == [f"g{k % 4}" for k in range(len(bad))]
    broken = bytearray(good[2])
    broken[300_000:300_050] = bytes(50)
    for hurt in (bytes(broken), good[2][:1000], b"rubbish" * 50_000, good[2][:-4] + b"\0\0\0\0"):
        rows = read(good[1] + hurt + good[3] + good[0])
        assert [r[2] for r in rows if not r[10]] == ["g1", "g3", "g0"], [r[10] for r in rows]
        assert any(r[10] for r in rows)
    cut = read(good[3] + good[2][:5000])
    assert [bool(r[10]) for r in cut] == [False, True]


def test_a_member_is_read_in_pieces():
    payload = b"a" * 50_000_000
    assert [r[7] for r in warc.records(io.BytesIO(member("big", payload)), "a", False)] == [len(payload)]
    assert zlib.decompress(warc._member(b"x"), 31) == b"x"
