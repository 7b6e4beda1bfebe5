"""TIFF stacks of any size: a data source whose tasks each read a range of pages by seeking, and a coder.

    spark.dataSource.register(TiffSource)
    spark.read.format("tiff").load(folder)     # path, page, height, width, kind, data

Files are found and opened by pyarrow's file systems, so paths may be local or in a store that pyarrow knows. A filter on `page` leaves out
the tasks, and within them the pages, that it rules out. Pages are uncompressed, LZW or deflate, with or without horizontal differencing, in
strips of grey values; the file may be of the large kind (64-bit offsets).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

# Fixed values of the format: tags, their types' sizes and codes, compressions.
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, SAMPLES, COUNTS, PREDICTOR, SAMPLE_FORMAT = 256, 257, 258, 259, 273, 277, 279, 317, 339
SIZES = {1: 1, 3: 2, 4: 4, 16: 8}
CODES = {1: "B", 3: "H", 4: "I", 16: "Q"}
PLAIN, LZW, DEFLATE, OLD_DEFLATE = 1, 5, 8, 32946
CLEAR, END, FIRST = 256, 257, 258

SCHEMA = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("page", T.LongType()), T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()),
     T.StructField("kind", T.StringType()), T.StructField("data", T.BinaryType())]
)


# -- LZW -----------------------------------------------------------------------------------------------------------


def lzw_encode(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the highest bit first; the width grows when the last code of a width is given out, and the table starts anew
    when it is full. Reading is one code behind, so it grows one code before."""
    out, hold, held, width = bytearray(), CLEAR, 9, 9
    known = {bytes([k]): k for k in range(256)}
    single, free, s = dict(known), FIRST, b""
    for k in range(len(data)):
        c = data[k : k + 1]
        longer = s + c
        if longer in known:
            s = longer
            continue
        hold, held = hold << width | known[s], held + width
        while held >= 8:
            held -= 8
            out.append(hold >> held & 255)
        hold &= (1 << held) - 1
        known[longer] = free
        free += 1
        s = c
        if free == 4095:
            hold, held, known, free, width = hold << width | CLEAR, held + width, dict(single), FIRST, 9
        elif free >= 1 << width and width < 12:
            width += 1
    if s:
        hold, held = hold << width | known[s], held + width
        free += 1
        if free >= 1 << width and width < 12:
            width += 1
    hold, held = hold << width | END, held + width
    pad = -held % 8
    return bytes(out) + (hold << pad).to_bytes((held + pad) // 8, "big")


def lzw_decode(data: bytes) -> bytes:
    table: list[bytes] = []
    out, hold, held, width, before, at = [], 0, 0, 9, b"", 0
    start = [bytes([k]) for k in range(256)] + [b"", b""]
    table = list(start)
    while True:
        while held < width:
            if at >= len(data):
                return b"".join(out)
            hold, held, at = hold << 8 | data[at], held + 8, at + 1
        held -= width
        code = hold >> held
        hold &= (1 << held) - 1
        if code == CLEAR:
            table, width, before = list(start), 9, b""
            continue
        if code == END:
            return b"".join(out)
        if not before:
            entry = table[code]
        else:
            if code < len(table):
                entry = table[code]
            elif code == len(table):
                entry = before + before[:1]
            else:
                raise ValueError("damaged LZW data")
            table.append(before + entry[:1])
            if len(table) >= (1 << width) - 1 and width < 12:
                width += 1
        out.append(entry)
        before = entry


# -- reading -------------------------------------------------------------------------------------------------------


@dataclass
class Layout:
    order: str
    big: bool
    first: int


def layout(f) -> Layout:
    f.seek(0)
    head = f.read(16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if order is None or len(head) < 8:
        raise ValueError("not a TIFF file")
    big = struct.unpack(order + "H", head[2:4])[0] == 43
    return Layout(order, big, struct.unpack(order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0])


def directory(f, how: Layout, at: int) -> tuple[dict[int, bytes], int]:
    """A page's tags as (type, count, value or its place), and the place of the next page's, 0 after the last."""
    head, size = ("Q", 20) if how.big else ("H", 12)
    word = "Q" if how.big else "I"
    f.seek(at)
    (n,) = struct.unpack(how.order + head, f.read(struct.calcsize(head)))
    body = f.read(n * size + struct.calcsize(word))
    tags = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(how.order + "HH" + word, body, k * size)
        tags[tag] = kind, count, body[k * size + (12 if how.big else 8) : (k + 1) * size]
    return tags, struct.unpack_from(how.order + word, body, n * size)[0]


def values(f, how: Layout, tag: tuple[int, int, bytes]) -> tuple[int, ...]:
    kind, count, raw = tag
    need = SIZES[kind] * count
    if need > len(raw):
        f.seek(struct.unpack(how.order + ("Q" if how.big else "I"), raw)[0])
        raw = f.read(need)
    return struct.unpack(f"{how.order}{count}{CODES[kind]}", raw[:need])


def page(f, how: Layout, tags: dict) -> np.ndarray:
    """A page's values in the byte order of the machine."""
    one = lambda tag, default=None: values(f, how, tags[tag])[0] if tag in tags else default
    width, height, bits, kind, predictor = one(WIDTH), one(HEIGHT), one(BITS, 8), one(COMPRESSION, PLAIN), one(PREDICTOR, 1)
    if one(SAMPLES, 1) != 1:
        raise ValueError("only grey pages are read")
    if kind not in (PLAIN, LZW, DEFLATE, OLD_DEFLATE):
        raise ValueError(f"compression {kind} isn't known")
    letter = {1: "u", 2: "i", 3: "f"}[one(SAMPLE_FORMAT, 1)]
    parts = []
    for at, size in zip(values(f, how, tags[OFFSETS]), values(f, how, tags[COUNTS])):
        f.seek(at)
        raw = f.read(size)
        parts.append(raw if kind == PLAIN else lzw_decode(raw) if kind == LZW else zlib.decompress(raw))
    a = np.frombuffer(b"".join(parts), f"{how.order}{letter}{bits // 8}", height * width).reshape(height, width)
    a = a.astype(a.dtype.newbyteorder("="))
    return np.cumsum(a, 1, a.dtype) if predictor == 2 else a


def pages(f, first: int = 0, last: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Numbers and values of the pages from first to before last; of those passed over only the directories are read."""
    how = layout(f)
    at, k = how.first, 0
    while at and (last is None or k < last):
        tags, at = directory(f, how, at)
        if k >= first:
            yield k, page(f, how, tags)
        k += 1


@dataclass
class Range(InputPartition):
    path: str
    first: int
    last: int | None


class TiffReader(DataSourceReader):
    def __init__(self, options: dict):
        self.fs, self.root = pafs.FileSystem.from_uri(options["path"])
        self.pages_per_task = int(options.get("pagespertask", 64))
        self.low, self.high = 0, None  # pages wanted: low to before high

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes what bounds the page; Spark checks all the filters again."""
        for f in filters:
            if getattr(f, "attribute", None) == ("page",):
                low, high = 0, None
                if isinstance(f, EqualTo):
                    low, high = f.value, f.value + 1
                elif isinstance(f, In) and f.value:
                    low, high = min(f.value), max(f.value) + 1
                elif isinstance(f, GreaterThan):
                    low = f.value + 1
                elif isinstance(f, GreaterThanOrEqual):
                    low = f.value
                elif isinstance(f, LessThan):
                    high = f.value
                elif isinstance(f, LessThanOrEqual):
                    high = f.value + 1
                self.low = max(self.low, low)
                self.high = high if self.high is None else self.high if high is None else min(self.high, high)
            yield f

    def partitions(self) -> list[InputPartition]:
        """Ranges of pages for each file. How many pages there are isn't read; a file's size over its first page's is the most for
        uncompressed ones, and the last range goes on to the end."""
        found = self.fs.get_file_info([self.root])[0]
        if found.type == pafs.FileType.Directory:
            files = [i for i in self.fs.get_file_info(pafs.FileSelector(self.root, recursive=True)) if i.is_file and i.base_name.lower().endswith((".tif", ".tiff"))]
        elif found.is_file:
            files = [found]
        else:
            raise FileNotFoundError(self.root)
        out: list[InputPartition] = []
        for info in sorted(files, key=lambda i: i.path):
            with self.fs.open_input_file(info.path) as f:
                how = layout(f)
                if not how.first:
                    continue
                tags, after = directory(f, how, how.first)
                size = sum(values(f, how, tags[COUNTS]))
            most = max(1, info.size // max(size, 1)) if after else 1
            high = most if self.high is None else min(self.high, most)
            first = self.low
            while first < high:
                last = first + self.pages_per_task
                end = self.high if last >= high else last
                out.append(Range(info.path, first, end))
                first = last
            if high <= self.low and (self.high is None or self.low < self.high):
                out.append(Range(info.path, self.low, self.high))
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        with self.fs.open_input_file(partition.path) as f:
            for k, a in pages(f, partition.first, partition.last):
                row = [[partition.path], [k], [a.shape[0]], [a.shape[1]], [a.dtype.str[1:]], [a.astype(a.dtype.newbyteorder("<")).tobytes()]]
                kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], names=SCHEMA.names)


class TiffSource(DataSource):
    """Options: path (a file or a folder, read through), pagesPerTask (64)."""

    @classmethod
    def name(cls) -> str:
        return "tiff"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return TiffReader({k.lower(): v for k, v in self.options.items()})


def read_pages(spark: SparkSession, path: str, frames: tuple[int, int] | None = None, pages_per_task: int = 64) -> DataFrame:
    """path, page (from 0), height, width, kind (such as u2) and data (values by rows, little-endian) of the stacks under a path, or of the
    inclusive range of their pages."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TiffSource)
    uri = path if "://" in path or not path.startswith("/") else "file://" + path
    df = spark.read.format("tiff").option("pagesPerTask", pages_per_task).load(uri)
    return df if frames is None else df.where(F.col("page").between(*frames))


def page_pixels(table: DataFrame) -> DataFrame:
    """path, page, y, x and v (a double) of pages; a task holds a page at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                path, number, height, width, kind, data = (b.column(c)[k].as_py() for c in SCHEMA.names)
                a = np.frombuffer(data, "<" + kind).reshape(height, width)
                y, x = np.indices(a.shape)
                n = a.size
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, number)), pa.array(y.ravel()), pa.array(x.ravel()), pa.array(a.ravel().astype(float))],
                    names=["path", "page", "y", "x", "v"],
                )

    return table.select(*SCHEMA.names).mapInArrow(run, "path string, page long, y long, x long, v double")


# -- writing -------------------------------------------------------------------------------------------------------


def encode(images: list[np.ndarray], compress: str | None = "lzw", big: bool = False) -> bytes:
    """A TIFF file of grey pages of unsigned, signed or floating values, one strip a page, LZW, deflate or plain."""
    how = {None: PLAIN, "lzw": LZW, "deflate": DEFLATE}[compress]
    word, place = ("Q", 8) if big else ("I", 4)
    out = bytearray(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 0) if big else struct.pack("<2sHI", b"II", 42, 0))
    link = 8 if big else 4
    for a in images:
        raw = np.ascontiguousarray(a).astype(a.dtype.newbyteorder("<")).tobytes()
        data = raw if how == PLAIN else lzw_encode(raw) if how == LZW else zlib.compress(raw)
        start = len(out)
        out += data + b"\0" * (len(data) % 2)
        struct.pack_into("<" + word, out, link, len(out))
        sort = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
        tags = [(WIDTH, a.shape[1]), (HEIGHT, a.shape[0]), (BITS, a.dtype.itemsize * 8), (COMPRESSION, how), (262, 1), (OFFSETS, start), (SAMPLES, 1), (278, a.shape[0]), (COUNTS, len(data)), (SAMPLE_FORMAT, sort)]
        out += struct.pack("<Q" if big else "<H", len(tags))
        out += b"".join(struct.pack("<HH" + word + word, t, 16 if big else 4, 1, v) for t, v in tags)
        link = len(out)
        out += b"\0" * place
    return bytes(out)
