"""TIFF files: the coder against itself, ranges of pages, and a sparse file beyond two gigabytes."""

import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.sources import tiff


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000), st.integers(1, 40))
def test_lzw_round_trip(data, times):
    assert tiff.lzw_decode(tiff.lzw_encode(data * times)) == data * times


def test_lzw_of_large_pages():
    rng = np.random.default_rng(0)
    for a in (rng.integers(0, 256, 300_000), np.zeros(500_000), np.arange(200_000) // 7 % 256):
        raw = a.astype(np.uint8).tobytes()
        code = tiff.lzw_encode(raw)
        assert tiff.lzw_decode(code) == raw
    assert len(tiff.lzw_encode(b"\0" * 500_000)) < 5_000


def test_lzw_of_a_known_code():
    # Fixed value: 7 7 7 8 8 7 7 6 6 as the format's description codes it, in nine bits each.
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]
    bits = "".join(f"{c:09b}" for c in codes)
    want = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert tiff.lzw_encode(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])) == want
    assert tiff.lzw_decode(want) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])


def stack(kind, n=5, shape=(13, 17)):
    rng = np.random.default_rng(1)
    return [(rng.random(shape) * 200).astype(kind) for _ in range(n)]


@pytest.mark.parametrize("compress", [None, "lzw", "deflate"])
@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("kind", ["u1", "u2", "u4", "i2", "f4"])
def test_files(spark, tmp_path, compress, big, kind):
    images = stack(kind)
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "s.tif").write_bytes(tiff.encode(images, compress, big))
    got = sorted(tiff.read_pages(spark, str(tmp_path), pages_per_task=2).collect(), key=lambda r: r.page)
    assert [r.page for r in got] == list(range(5))
    for r, a in zip(got, images):
        assert r.kind == kind and (np.frombuffer(r.data, "<" + r.kind).reshape(r.height, r.width) == a).all()


def test_pixels_of_a_range(spark, tmp_path):
    images = stack("u2", 9)
    (tmp_path / "s.tif").write_bytes(tiff.encode(images))
    px = tiff.page_pixels(tiff.read_pages(spark, str(tmp_path / "s.tif"), (3, 4), 2)).toPandas()
    assert set(px.page) == {3, 4} and len(px) == 2 * 13 * 17
    for k in (3, 4):
        p = px[px.page == k]
        assert (images[k][p.y, p.x] == p.v).all()


def test_predictor(tmp_path):
    a = stack("u1", 1)[0]
    step = np.diff(a.astype(np.uint8), axis=1, prepend=0).astype(np.uint8)
    data = bytearray(tiff.encode([step], None))
    at = struct.unpack_from("<I", data, 4)[0]
    n = struct.unpack_from("<H", data, at)[0]
    for k in range(n):  # the tag that states one sample a pixel is made the predictor's
        if struct.unpack_from("<H", data, at + 2 + 12 * k)[0] == tiff.SAMPLES:
            struct.pack_into("<HHII", data, at + 2 + 12 * k, tiff.PREDICTOR, 4, 1, 2)
    (tmp_path / "p.tif").write_bytes(data)
    with open(tmp_path / "p.tif", "rb") as f:
        assert (next(tiff.pages(f))[1] == a).all()


def test_filters_leave_out_tasks(tmp_path):
    (tmp_path / "s.tif").write_bytes(tiff.encode(stack("u2", 40), None))
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

    def ranges(*filters):
        reader = tiff.TiffReader({"path": f"file://{tmp_path}", "pagespertask": "10"})
        assert list(reader.pushFilters(list(filters))) == list(filters)
        return [(p.first, p.last) for p in reader.partitions()]

    whole = ranges()
    assert whole[0] == (0, 10) and whole[-1][1] is None
    assert ranges(EqualTo(("page",), 25)) == [(25, 26)]
    assert ranges(GreaterThanOrEqual(("page",), 12), LessThan(("page",), 31)) == [(12, 22), (22, 31)]
    assert ranges(EqualTo(("path",), "x")) == whole


def test_a_sparse_file_beyond_two_gigabytes(spark, tmp_path):
    """Three pages, the last two behind three gigabytes of nothing, written as a file with a hole."""
    images = stack("u2", 3, (50, 60))
    far = 3 << 30
    head = bytearray(tiff.encode(images[:1], None, big=True))
    rest = tiff.encode(images[1:], None, big=True)
    at = struct.unpack_from("<Q", rest, 8)[0]
    path = tmp_path / "big.tif"
    link = len(head) - 8
    struct.pack_into("<Q", head, link, far + at)
    moved = bytearray(rest)
    while at:  # all places in the second part lie `far` bytes on
        n = struct.unpack_from("<Q", moved, at)[0]
        for k in range(n):
            if struct.unpack_from("<H", moved, at + 8 + 20 * k)[0] == tiff.OFFSETS:
                struct.pack_into("<Q", moved, at + 8 + 20 * k + 12, struct.unpack_from("<Q", moved, at + 8 + 20 * k + 12)[0] + far)
        after = struct.unpack_from("<Q", moved, at + 8 + 20 * n)[0]
        if after:
            struct.pack_into("<Q", moved, at + 8 + 20 * n, after + far)
        at = after
    with open(path, "wb") as f:
        f.write(head)
        f.seek(far)
        f.write(moved)
    assert path.stat().st_size > 2 << 30
    got = tiff.read_pages(spark, str(path), (1, 2)).orderBy("page").collect()
    assert [r.page for r in got] == [1, 2]
    for r, a in zip(got, images[1:]):
        assert (np.frombuffer(r.data, "<u2").reshape(50, 60) == a).all()


def test_damaged_and_missing(tmp_path):
    (tmp_path / "x.tif").write_bytes(b"nothing of the kind")
    with pytest.raises(ValueError, match="not a TIFF"), open(tmp_path / "x.tif", "rb") as f:
        next(tiff.pages(f))
    with pytest.raises(FileNotFoundError):
        tiff.TiffReader({"path": f"file://{tmp_path}/none.tif"}).partitions()


def test_written_stacks(spark, tmp_path):
    from tessera.sources import readers, sinks

    rng = np.random.default_rng(4)
    a = {(r, c): (rng.random((3, 6, 7)) * 60_000).astype("u2") for r in ("round1", "round2") for c in ("ch00", "ch01")}
    rows = [(r, c, "tile_1", z, y, x, int(v[z, y, x])) for (r, c), v in a.items() for z in range(3) for y in range(6) for x in range(7)]
    px = spark.createDataFrame(rows, "round string, channel string, fov string, z long, y long, x long, v long")
    sinks.write_stacks(px, ["round", "channel", "fov"], str(tmp_path / "out"), "{round}/{fov}/{channel}.tif", 6, 7, compress="lzw")
    back = readers.read_stacks(spark, str(tmp_path / "out")).toPandas()
    assert len(back) == len(rows)
    for (r, c), v in a.items():
        p = back[(back["round"] == r) & (back.channel == c)]
        assert (v[p.z, p.y, p.x] == p.v).all() and len(p) == v.size
    with pytest.raises(Exception, match="can't hold"):
        sinks.write_stacks(px.withColumn("v", px.v - 1_000_000), ["round", "channel", "fov"], str(tmp_path / "bad"), "{round}/{channel}.tif", 6, 7)
    sinks.write_stacks(px.withColumn("v", px.v / 7), ["round", "channel", "fov"], str(tmp_path / "real"), "{round}/{channel}.tif", 6, 7, kind="f4")
    real = tiff.page_pixels(tiff.read_pages(spark, str(tmp_path / "real"))).toPandas()
    assert np.isclose(real.v.sum(), sum(v.sum() for v in a.values()) / 7, rtol=1e-5)
