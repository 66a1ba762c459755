from __future__ import annotations

import hashlib

import numpy as np
import pytest

from cinderlake.llm import media_chunks as M


def brute_cuts(raw, low, bits, high):
    out, begin = [], 0
    while begin < len(raw):
        end = min(len(raw), begin + high)
        for i in range(begin + low - 1, end - 1):
            h = 0
            for k in range(max(0, i - 31), i + 1):
                h = ((h << 1) + int(M._GEAR[raw[k]])) & 0xFFFFFFFF
            if h >> (32 - bits) == 0:
                end = i + 1
                break
        out.append(end)
        begin = end
    return out


def payloads():
    r = np.random.default_rng(2)
    base = r.integers(0, 256, 40_000, dtype=np.uint8).tobytes()
    return [(1, base), (2, base[:9000] + b"inserted" + base[9000:]), (3, None), (4, b""), (5, b"x"), (5, b"x"), (None, base), (6, b"\0" * 20_000), (7, r.integers(0, 256, 3_000_000, dtype=np.uint8).tobytes())]


def test_cuts_equal_brute_force():
    for _, raw in payloads()[:2]:
        data = np.frombuffer(raw[:6000], np.uint8)
        assert M.cuts(data, 64, 6, 512) == brute_cuts(raw[:6000], 64, 6, 512)
    assert M.cuts(np.zeros(0, np.uint8)) == []


def test_strides_do_not_change_cuts(monkeypatch):
    data = np.frombuffer(payloads()[8][1], np.uint8)
    whole = M.cuts(data)
    monkeypatch.setattr(M, "_STRIDE", 1000)
    assert M.cuts(data) == whole


CLASHING = ("media", "chunk", "chunks", "sizes", "own", "whole", "bytes", "key", "kind", "bucket", "blob", "payload", "n_bytes", "n_chunks", "verified", "__own", "__media")


def frame_of(spark, rows):
    return spark.createDataFrame([(i, p, *("x" for _ in CLASHING)) for i, p in rows], "page_id bigint, html binary, " + ", ".join(f"`{c}` string" for c in CLASHING))


@pytest.mark.parametrize("bucket_bytes", [M.BUCKET_BYTES, 200_000])
def test_round_trip_and_dedup(spark, tmp_path, monkeypatch, bucket_bytes):
    monkeypatch.setattr(M, "BUCKET_BYTES", bucket_bytes)
    rows = payloads()
    frame = frame_of(spark, rows)
    path = str(tmp_path / "store")
    got = M.chunk_report(frame, path).collect()
    assert len(got) == len(rows) and all(r.verified or r.page_id == 3 for r in got)
    by = {r.page_id: r for r in got}
    assert by[3].chunks is None and by[3].n_chunks is None and by[3].verified is None
    assert by[4].n_chunks == 0 and by[4].n_bytes == 0 and by[4].verified
    for i, raw in rows:
        if raw is not None and i is not None:
            ends = M.cuts(np.frombuffer(raw, np.uint8))
            assert by[i].n_bytes == len(raw) and by[i].media == hashlib.sha256(raw).hexdigest()
            assert by[i].chunks == [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip([0, *ends], ends)]
    # one insertion changes a chunk or two of about forty
    assert len(set(by[1].chunks) & set(by[2].chunks)) >= len(by[1].chunks) - 3

    def stored():
        packs, shared = M._read(spark, path, "packs").collect(), M._read(spark, path, "shared").collect()
        assert all(hashlib.sha256(bytes(s.bytes)).digest() == bytes(s.chunk) for s in shared)
        return [bytes(p.chunks[i]) for p in packs for i in p.own] + [bytes(s.chunk) for s in shared]

    held = stored()
    assert len(held) == len(set(held)) and {c.hex() for c in held} == {c for r in got for c in r.chunks or ()}
    M.add_chunks(frame, path, "html")
    assert len(stored()) == len(held)
    rebuilt = {bytes(r.media): bytes(r.payload) for r in M.payloads_of(M.recipes(frame, "html"), path).collect()}
    assert sorted(rebuilt.values()) == sorted({raw for _, raw in rows if raw is not None})
    # a later payload made of others' chunks finds them in their packs
    mixed = rows[8][1][:500_000] + rows[0][1]
    later = frame_of(spark, [(9, mixed)])
    assert M.chunk_report(later, path).first().verified and len(stored()) < len(held) + 6
    assert bytes(M.payloads_of(M.recipes(later, "html"), path).first().payload) == mixed
    broken = M.reconstruct(M.recipes(frame, "html"), str(tmp_path / "elsewhere")).collect()
    assert [r.verified for r in broken].count(True) == 1  # the empty payload
    assert M.chunk_report(frame.limit(0), str(tmp_path / "none")).count() == 0


def test_wrong_recipes_are_not_verified(spark, tmp_path):
    rows, path = payloads()[:2] + payloads()[6:], str(tmp_path / "store")
    frame = frame_of(spark, rows)
    M.add_chunks(frame, path, "html")
    right = M.recipes(frame, "html")
    assert all(r.verified for r in M.reconstruct(right, path).collect())
    longer = right.where("size(chunks) > 3")
    assert longer.count() >= 3
    turned = longer.selectExpr("media", "reverse(chunks) AS chunks", "reverse(sizes) AS sizes")
    resized = longer.selectExpr("media", "chunks", "reverse(sizes) AS sizes")
    short = longer.selectExpr("media", "slice(chunks, 1, size(chunks) - 1) AS chunks", "slice(sizes, 1, size(sizes) - 1) AS sizes")
    swapped = longer.selectExpr("unhex(sha2(media, 256)) AS media", "chunks", "sizes")
    for wrong in (turned, resized, short, swapped):
        found = M.reconstruct(wrong, path).collect()
        assert len(found) == longer.count() and not any(r.verified for r in found)
    # a store whose packs hold a shuffled recipe or other bytes
    packs = M._read(spark, path, "packs").where("size(chunks) > 3")
    for name, changed in (("turned", {"chunks": "reverse(chunks)", "sizes": "reverse(sizes)"}), ("bytes", {"bytes": "reverse(bytes)"})):
        other = str(tmp_path / name)
        packs.selectExpr(*(f"{changed.get(c, c)} AS {c}" for c in packs.columns if c != "bytes"), f"CAST({'unhex(reverse(hex(bytes)))' if name == 'bytes' else 'bytes'} AS binary) AS bytes").write.parquet(f"{other}/packs")
        M._read(spark, path, "shared").write.parquet(f"{other}/shared")
        assert not any(r.verified for r in M._stored(other, spark).collect())
