"""WARC bundles: round trip, revisits, seeking, odd pages."""

import glob
import hashlib

import pytest
import zstandard

from hirefunnel.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload int, `a.b` int, start long"


def frame(spark, rows, parts=3):
    rows = [(i, u, h, "x", 1, 2, 3) for i, u, h in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def expected(rows, least=100):
    """page_id, payload_bytes, payload_digest, record_type, refers_to by the definition."""
    bodies = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, body in bodies:
        same = [k for k, other in bodies if other == body and k is not None]
        first = min(same) if same and len(body) >= least else i
        kind = "response" if first == i else "revisit"
        refers = first if kind == "revisit" else None
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), kind, refers))
    return sorted(out, key=repr)


def pages():
    long = "<p>" + "é日😀 text " * 40 + "</p>"
    rows = [(i, f"http://h/{i}", long if i % 3 == 0 else f"<b>{i}</b>" * 60) for i in range(40, 0, -1)]
    rows += [(50, None, None), (51, "http://h/ä b\r\nWARC-Type: revisit", ""), (52, "u", "")]
    rows += [(60, "u", "short"), (61, "u", "short"), (62, "u", "x" * 99), (63, "u", "x" * 99)]
    rows += [(64, "u", "y" * 100), (65, "u", "y" * 100), (70, "u", "z\r\n\r\nWARC/1.1\r\n" * 60_000)]
    return rows


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
@pytest.mark.parametrize("frame_bytes, bundle_bytes", [(1, 1), (2000, 5000), (1 << 20, 1 << 27)])
def test_round_trip(spark, folder, frame_bytes, bundle_bytes, broadcast_rows):
    rows = pages()
    options = {"frame_bytes": frame_bytes, "bundle_bytes": bundle_bytes, "broadcast_rows": broadcast_rows}
    index = warc.archive(frame(spark, rows), f"{folder}/w", **options)
    got = warc.records(spark, f"{folder}/w")
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)
    assert index.count() == len(rows)


def test_fetch_reads_single_records(spark, folder):
    rows = pages()
    warc.archive(frame(spark, rows), f"{folder}/w", frame_bytes=3000)
    wanted = [3, 3, 1, 39, 50, 65, 70, 999, None]
    asked = spark.createDataFrame([(i, 0) for i in wanted], "page_id long, place int")
    got = {r.page_id: bytes(r.payload).decode() for r in warc.fetch(spark, f"{folder}/w", asked).collect()}
    body = {i: h or "" for i, _, h in rows}
    assert got == {i: body[i] for i in {3, 1, 39, 50, 65, 70}}


def test_bundles_are_plain_zstandard_of_plain_records(spark, folder):
    warc.archive(frame(spark, pages(), 1), f"{folder}/w", frame_bytes=500)
    (path,) = glob.glob(f"{folder}/w/*.warc.zst")
    with open(path, "rb") as file:
        reader = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True)
        raw = reader.read()
    at, n = 0, 0
    while at < len(raw):
        _, _, at = warc.parsed(raw, at)
        n += 1
    assert n == len(pages())


def test_damage_is_noticed(spark, folder):
    warc.archive(frame(spark, [(1, "u", "a" * 500)], 1), f"{folder}/w")
    (path,) = glob.glob(f"{folder}/w/*.warc.zst")
    raw = zstandard.ZstdDecompressor().decompress(open(path, "rb").read()).replace(b"aaa", b"aba", 1)
    packed = zstandard.ZstdCompressor().compress(raw)
    with open(path, "wb") as file:
        file.write(packed + warc.seek_table([(len(packed), len(raw))]))
    with pytest.raises(Exception, match="damaged record"):
        warc.records(spark, f"{folder}/w").collect()


def test_files_of_lost_attempts_are_not_read(spark, folder):
    rows = pages()
    warc.archive(frame(spark, rows), f"{folder}/w")
    (path, *_) = glob.glob(f"{folder}/w/*.warc.zst")
    with open(path, "rb") as file, open(f"{folder}/w/lost.warc.zst", "wb") as lost:
        lost.write(file.read()[:100])
    assert sorted(map(tuple, warc.records(spark, f"{folder}/w").collect()), key=repr) == expected(rows)


def test_no_pages_null_ids_and_repeated_rows(spark, folder):
    warc.archive(frame(spark, []), f"{folder}/none")
    assert warc.records(spark, f"{folder}/none").collect() == []
    rows = [(None, "u", "a" * 200), (None, "u", "a" * 200), (5, "u", "b" * 200), (5, "u", "b" * 200)]
    rows += [(None, "u", "b" * 200), (6, "u", "b" * 200), (None, None, None)]
    warc.archive(frame(spark, rows), f"{folder}/odd")
    assert sorted(map(tuple, warc.records(spark, f"{folder}/odd").collect()), key=repr) == expected(rows)
