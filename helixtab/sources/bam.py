"""Binary alignments as a data source: spark.read.format("bam"), df.write.format("bam").

Files are read in stretches of blocks, one to a task, so the work is spread over a file of any size. A filter on chrom, pos0 and end0
goes to the file's index, and only the blocks that may hold such alignments are read. Only the columns of the schema
that is given are decoded. Call register(spark) first.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from helixtab.sources import bgzf
from helixtab.sources.regions import Region

SCHEMA = (
    "sample string, read_name string, flag int, chrom string, pos0 long, mapq int, cigar string, mate_chrom string, mate_pos0 long, insert_size int, "
    "query string, quals string, tags map<string, string>, end0 long, offset long"
)
#: Fixed values of the format: operations of a cigar, those that take up reference, bases by number, sizes and kinds of tag values.
OPERATIONS, ON_REFERENCE, BASES = "MIDNSHP=X", "MDN=X", "=ACMGRSVTWYHKDBN"
NUMBER = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
MAGIC, INDEX_MAGIC = b"BAM\1", b"BAI\1"
#: Compressed bytes of a task; text that is decoded at once.
SPLIT, BATCH = 32 << 20, 4 << 20


class Part(InputPartition):
    """Records that start at virtual offset first or later, and in a block before the file's place last (or before the virtual offset stop).

    guess: first is any place in the file; records are looked for from the next block on.
    """

    def __init__(self, path: str, first: int, last: int, stop: int | None = None, guess: bool = False):
        super().__init__(None)
        self.path, self.first, self.last, self.stop, self.guess = path, first, last, stop, guess


def header(path: str) -> tuple[str, list[tuple[str, int]], int]:
    """(text, references with their lengths, virtual offset of the first record)."""
    reader = bgzf.Reader(path)
    data, at, starts = b"", 0, []

    def need(n: int) -> None:
        nonlocal data, at
        while len(data) < n:
            text, after = reader.text(at)
            starts.append((len(data), at))
            data, at = data + text, after

    need(12)
    if data[:4] != MAGIC:
        raise ValueError(f"{path} holds no alignments")
    (n,) = struct.unpack_from("<i", data, 4)
    need(12 + n)
    text, place = data[8 : 8 + n].split(b"\0")[0].decode(), 12 + n
    references = []
    for _ in range(struct.unpack_from("<i", data, 8 + n)[0]):
        need(place + 4)
        (k,) = struct.unpack_from("<i", data, place)
        need(place + 8 + k)
        references.append((data[place + 4 : place + 3 + k].decode(), struct.unpack_from("<i", data, place + 4 + k)[0]))
        place += 8 + k
    reader.close()
    begin, block = max((s for s in starts if s[0] <= place), default=(0, 0))
    return text, references, at << 16 if place == len(data) else block << 16 | place - begin


def index_of(path: str, references: int) -> bgzf.Index | None:
    data = bgzf.whole(f"{path}.bai") or bgzf.whole(re.sub(r"\.bam$", ".bai", path))
    return bgzf.Index.parse(data, 8, references) if data and data[:4] == INDEX_MAGIC else None


def plausible(data: bytes, at: int, lengths: list[int]) -> int:
    """Where the next record starts if one may start at a place in data, 0 if none can, -1 if the data ends before that shows."""
    if at + 36 > len(data):
        return -1
    size, ref, pos, name, _, _, cigar, _, letters, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    fits = 32 + name + 4 * cigar + (letters + 1) // 2 + letters <= size <= 1 << 28
    if not (name and fits and letters >= 0 and -1 <= ref < len(lengths) and -1 <= mate < len(lengths) and -1 <= pos and -1 <= mate_pos):
        return 0
    if ref >= 0 and pos >= lengths[ref] or mate >= 0 and mate_pos >= lengths[mate]:
        return 0
    own = data[at + 36 : at + 36 + name]
    if len(own) < name:
        return -1
    if own[-1] or not all(33 <= c <= 126 for c in own[:-1]):
        return 0
    if any(op & 15 > 8 for op in struct.unpack_from(f"<{cigar}I", data, at + 36 + name)) if at + 36 + name + 4 * cigar <= len(data) else False:
        return 0
    return at + 4 + size


def first_record(data: bytes, lengths: list[int], upto: int, whole: bool) -> int:
    """The first place below upto from which records follow each other as far as data goes, -1 if there is none; whole: data ends with the file."""
    for at in range(upto):
        place, many = at, 0
        while True:
            after = plausible(data, place, lengths)
            if after <= 0:
                break
            place, many = after, many + 1
            if place >= len(data):
                break
        if after and (many and (place == len(data) or not whole)):
            return at
    return -1


def _gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of stretches of data, end to end, and their ends."""
    end = np.cumsum(size)
    return data[np.repeat(start - (end - size), size) + np.arange(int(size.sum()))], end


def _strings(data: np.ndarray, end: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(end), pa.py_buffer(np.concatenate(([0], end)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


def tag_map(data: bytes) -> list[tuple[str, str]]:
    """(name, text) of a record's tags; numbers as SAM text has them."""
    at, out = 0, []
    while at < len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(b"\0", at)
            value, at = data[at:end].decode(), end + 1
        elif kind == "A":
            value, at = chr(data[at]), at + 1
        elif kind == "B":
            kind, n = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            values = struct.unpack_from(f"<{n}{NUMBER[kind]}", data, at + 5)
            value = ",".join([kind, *(f"{v:g}" if kind == "f" else str(v) for v in values)])
            at += 5 + n * struct.calcsize(NUMBER[kind])
        else:
            (v,) = struct.unpack_from("<" + NUMBER[kind], data, at)
            value, at = f"{v:g}" if kind == "f" else str(v), at + struct.calcsize(NUMBER[kind])
        out.append((name, value))
    return out


def decoded(data: bytes, start: np.ndarray, offsets: np.ndarray, references: list[str], sample: str, names: list[str], cigars: dict[bytes, tuple[str, int]]) -> dict[str, pa.Array]:
    """Columns of the records that start at places of data."""
    raw = np.frombuffer(data, np.uint8)
    fixed = raw[start[:, None] + np.arange(36)].view("<i4")
    ref, pos, letters, mate, mate_pos, size = (fixed[:, i] for i in (1, 2, 5, 6, 7, 0))
    name, mapq = fixed[:, 3] & 255, fixed[:, 3] >> 8 & 255
    many, flag = (fixed[:, 4] & 0xFFFF).astype(np.int64), fixed[:, 4] >> 16 & 0xFFFF
    chroms = pa.array([*references, "*"])
    named = lambda r: chroms.take(pa.array(np.where(r < 0, len(references), r)))
    out: dict[str, pa.Array] = {}
    wanted = set(names)
    at_cigar = start + 36 + name
    at_seq = at_cigar + 4 * many
    at_qual = at_seq + (letters + 1) // 2
    if wanted & {"cigar", "end0"}:
        texts, ends = [], []
        for a, b, p in zip(at_cigar.tolist(), at_seq.tolist(), pos.tolist(), strict=True):
            own = data[a:b]
            if own not in cigars:
                ops = [(v >> 4, OPERATIONS[v & 15]) for v in struct.unpack(f"<{len(own) // 4}I", own)]
                cigars[own] = "".join(f"{n}{o}" for n, o in ops) or "*", sum(n for n, o in ops if o in ON_REFERENCE)
            text, length = cigars[own]
            texts.append(text), ends.append(p + max(1, length))
        out |= {"cigar": pa.array(texts, pa.string()), "end0": pa.array(ends, pa.int64())}
    if "query" in wanted:
        n = np.maximum(letters, 1).astype(np.int64)
        end = np.cumsum(n)
        nth = np.arange(int(n.sum())) - np.repeat(end - n, n)
        byte = raw[np.minimum(np.repeat(at_seq, n) + nth // 2, len(raw) - 1)]
        text = np.frombuffer(BASES.encode(), np.uint8)[np.where(nth % 2, byte & 15, byte >> 4)]
        text[(end - 1)[letters == 0]] = ord("*")
        out["query"] = _strings(text, end)
    if "quals" in wanted:
        none = (letters == 0) | (raw[np.minimum(at_qual, len(raw) - 1)] == 255)
        text, end = _gathered(raw, np.where(none, start, at_qual), np.where(none, 1, letters).astype(np.int64))
        text = text + np.uint8(33)
        text[(end - 1)[none]] = ord("*")
        out["quals"] = _strings(text, end)
    if "tags" in wanted:
        text, end = _gathered(raw, (at_qual + letters).astype(np.int64), (start + 4 + size - at_qual - letters).astype(np.int64))
        own = _strings(text, end).view(pa.binary()).dictionary_encode()  # alike ones are taken apart once
        out["tags"] = pa.array([tag_map(x) for x in own.dictionary.to_pylist()], pa.map_(pa.string(), pa.string())).take(own.indices)
    if "read_name" in wanted:
        out["read_name"] = _strings(*_gathered(raw, start + 36, (name - 1).astype(np.int64)))
    if "mate_chrom" in wanted:
        out["mate_chrom"] = pc.if_else(pa.array((mate == ref) & (mate >= 0)), "=", named(mate))
    out |= {"chrom": named(ref), "offset": pa.array(offsets)}
    for k, v in {"flag": flag, "pos0": pos, "mapq": mapq, "mate_pos0": mate_pos, "insert_size": fixed[:, 8]}.items():
        out[k] = pa.array(v)
    if "sample" in wanted:
        out["sample"] = pa.array([sample] * len(start), pa.string())
    return out


class Alignments(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options, self.region = schema, options, Region("chrom", "pos0", "end0")

    def pushFilters(self, filters):
        for f in filters:
            self.region.add(f)
        yield from filters  # blocks hold others too, so they are evaluated again

    def partitions(self):
        split = int(self.options.get("split", SPLIT))
        out = []
        for path, size in bgzf.listed(self.options["path"], (".bam",)):
            _, references, first = header(path)
            index = index_of(path, len(references)) if self.region.bounded() else None
            if index is None:
                starts = [first, *((at << 16) for at in range(((first >> 16) // split + 1) * split, size, split))]
                out += [Part(path, a, (b >> 16) if b else size, None, a != first) for a, b in zip(starts, [*starts[1:], 0], strict=True)]
                continue
            for number, (name, length) in enumerate(references):
                low, high = self.region.of(name, length)
                if low < high:
                    out += [Part(path, a, b >> 16, b) for a, b in index.chunks(number, low, high)]
        return out or [Part("", 0, 0)]

    def read(self, part: Part):
        if not part.path:
            return
        names = [f.name for f in self.schema.fields]
        kinds = to_arrow_schema(self.schema)
        _, references, _ = header(part.path)
        lengths = [n for _, n in references]
        sample = re.sub(r"\.bam$", "", part.path.rsplit("/", 1)[-1])
        reader, cigars = bgzf.Reader(part.path), {}
        at = reader.first_block(part.first >> 16) if part.guess else part.first >> 16
        skip = None if part.guess else part.first & 0xFFFF
        data, begins, places = b"", [], []  # text held, where blocks begin in it and in the file
        done = False
        while not done and (at < reader.size or data):
            while at < reader.size and len(data) < BATCH:
                text, after = reader.text(at)
                if text:
                    begins.append(len(data)), places.append(at)
                    data += text
                at = after
            if skip is None:
                upto = next((b for b, p in zip(begins, places, strict=True) if p >= part.last), len(data))
                skip = first_record(data, lengths, upto, at >= reader.size)
                if skip < 0:
                    break
            starts, place = [], skip
            while place + 4 <= len(data):
                after = place + 4 + struct.unpack_from("<i", data, place)[0]
                if after > len(data):
                    break
                starts.append(place)
                place = after
            if not starts and at >= reader.size:
                if place < len(data):
                    raise ValueError(f"{part.path} ends within a record")
                break
            start = np.array(starts, np.int64)
            nth = np.searchsorted(begins, start, "right") - 1
            offsets = (np.array(places, np.int64)[nth] << 16 | start - np.array(begins, np.int64)[nth]) if len(start) else start
            own = offsets < (part.stop if part.stop is not None else part.last << 16)
            done = not own.all()
            start, offsets = start[own], offsets[own]
            if len(start):
                columns = decoded(data, start, offsets, [n for n, _ in references], sample, names, cigars)
                yield pa.RecordBatch.from_arrays([columns[n].cast(kinds.field(n).type) for n in names], schema=kinds)
            if place == skip and at < reader.size:  # a record longer than what is read at once
                text, after = reader.text(at)
                begins.append(len(data)), places.append(at)
                data, at = data + text, after
                continue
            keep = max(0, int(np.searchsorted(begins, place, "right")) - 1) if place < len(data) else len(begins)
            cut = begins[keep] if keep < len(begins) else len(data)
            data, skip = data[cut:], place - cut
            begins, places = [b - cut for b in begins[keep:]], places[keep:]
        reader.close()


@dataclass
class Written(WriterCommitMessage):
    paths: list


def _spread(out: np.ndarray, at: np.ndarray, size: np.ndarray, data: np.ndarray) -> None:
    """Put stretches of data, which lie end to end, at places of out."""
    end = np.cumsum(size)
    out[np.repeat(at - (end - size), size) + np.arange(len(data))] = data


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, one for each character, end to end, and how many each has; null and '*' have none."""
    texts = pc.if_else(pc.fill_null(pc.equal(texts, "*"), True), pa.array([""] * len(texts)), texts.cast(pa.string()))
    if pc.sum(pc.binary_length(texts)).as_py() != pc.sum(pc.utf8_length(texts)).as_py():
        texts = pc.replace_substring_regex(texts, "[^\\x00-\\x7F]", "N")
    return whole(texts)


def whole(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, end to end, and how many each has."""
    texts = texts.cast(pa.binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]], np.diff(bounds)


def _packed_tag(name: str, value: str) -> bytes:
    whole = re.fullmatch(r"-?[1-9]\d{0,8}|0", value)
    return name.encode() + (b"i" + struct.pack("<i", int(value)) if whole else b"Z" + value.encode() + b"\0")


_HEAD = np.dtype([(n, k) for n, k in zip(("size", "ref", "pos", "name", "mapq", "bin", "ops", "flag", "letters", "mate", "mate_pos", "insert"), ("<i4", "<i4", "<i4", "u1", "u1", "<u2", "<u2", "<u2", "<i4", "<i4", "<i4", "<i4"), strict=True)])
_CODES = np.full(256, 15, np.uint8)
for _i, _c in enumerate(BASES):
    _CODES[[ord(_c), ord(_c.lower())]] = _i


def packed(b: pa.RecordBatch, names: pa.Array, tag_bytes: dict[tuple[str, str], bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(records end to end, their sizes, numbers of their references, starts, ends, bins) of rows."""
    n = b.num_rows
    if b["read_name"].null_count:
        raise ValueError("an alignment has no name")
    number = lambda c: pc.fill_null(pc.index_in(b[c], names), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    value = lambda c: b[c].to_numpy(zero_copy_only=False).astype(np.int64)
    ref, pos = number("chrom"), value("pos0")
    mate = np.where(pc.fill_null(pc.equal(b["mate_chrom"], "="), False).to_numpy(zero_copy_only=False), ref, number("mate_chrom"))
    cigars = pc.fill_null(b["cigar"], "").dictionary_encode()
    found = [[(int(k), OPERATIONS.index(o)) for k, o in re.findall(r"(\d+)([MIDNSHP=X])", c)] for c in cigars.dictionary.to_pylist()]
    which = cigars.indices.to_numpy()
    length = np.array([max(1, sum(k for k, o in ops if OPERATIONS[o] in ON_REFERENCE)) for ops in found], np.int64)[which]
    cigar, cigar_size = whole(pa.array([b"".join(struct.pack("<I", k << 4 | o) for k, o in ops) for ops in found], pa.binary()).take(cigars.indices))
    name, name_size = whole(pc.binary_join_element_wise(b["read_name"].cast(pa.binary()), pa.scalar(b"\0", pa.binary()), pa.scalar(b"", pa.binary())))
    query, letters = _letters(b["query"])
    half = (letters + 1) // 2
    codes = np.zeros(2 * int(half.sum()), np.uint8)
    _spread(codes, 2 * (np.cumsum(half) - half), letters, _CODES[query])
    given, given_size = _letters(b["quals"])
    none = pc.fill_null(pc.equal(b["quals"], "*"), True).to_numpy(zero_copy_only=False)
    qual_size = np.where(none, letters, given_size)
    quals = np.full(int(qual_size.sum()), 255, np.uint8)
    _spread(quals, np.cumsum(qual_size) - qual_size, given_size, given - np.uint8(33))
    pairs, tags = b["tags"], []
    bounds = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(pairs.cast(pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())])))), 0).to_numpy(zero_copy_only=False)))).astype(np.int64)
    flat = pairs.cast(pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())]))).flatten()
    if len(tag_bytes) > 1 << 18:
        tag_bytes.clear()
    for pair in zip(flat.field("key").to_pylist(), flat.field("value").to_pylist(), strict=True):
        if pair not in tag_bytes:
            tag_bytes[pair] = _packed_tag(*pair)
        tags.append(tag_bytes[pair])
    tag_ends = np.concatenate(([0], np.cumsum([len(x) for x in tags]))).astype(np.int64)
    tag_size = np.diff(tag_ends[bounds])
    size = 36 + name_size + cigar_size + half + qual_size + tag_size
    start = np.cumsum(size) - size
    start0, end = np.maximum(pos, 0), np.maximum(pos + length, 1)
    places = bgzf.bins_of(start0, end)
    head = np.zeros(n, _HEAD)
    fixed = {"size": size - 4, "ref": ref, "pos": pos, "name": name_size, "mapq": value("mapq"), "bin": places, "ops": cigar_size // 4, "flag": value("flag"), "letters": letters, "mate": mate, "mate_pos": value("mate_pos0"), "insert": value("insert_size")}
    for k, v in fixed.items():
        kind = _HEAD[k]
        if len(v) and (v.min() < np.iinfo(kind).min or v.max() > np.iinfo(kind).max):
            raise ValueError(f"{k} is out of the format's range")
        head[k] = v
    out = np.empty(int(size.sum()), np.uint8)
    out[(start[:, None] + np.arange(36)).ravel()] = head.view(np.uint8)
    at = start + 36
    for data, own in ((name, name_size), (cigar, cigar_size), ((codes[::2] << 4 | codes[1::2]), half), (quals, qual_size), (np.frombuffer(b"".join(tags), np.uint8), tag_size)):
        _spread(out, at, own, data)
        at = at + own
    return out, size, ref, start0, end, places


def cut(batch: pa.RecordBatch, rows: int = 4096):
    """Rows of a batch, few at a time, so that what is laid out at once is small."""
    return (batch.take(pa.array(np.arange(i, min(i + rows, batch.num_rows)))) for i in range(0, batch.num_rows, rows))


class AlignmentWriter(DataSourceArrowWriter):
    """A file for each task, with an index if its rows are in the order of references and places."""

    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.overwrite = options["path"], overwrite
        self.references = [(n, int(k)) for n, k in json.loads(options["references"])]
        fs, at = bgzf.located(self.folder)
        fs.create_dir(at, recursive=True)
        self.old = [p for p, _ in bgzf.listed(self.folder, (".bam", ".bai"))] if overwrite else []

    def write(self, iterator):
        path = f"{self.folder.rstrip('/')}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bam"
        text = ("@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{k}\n" for n, k in self.references)).encode()
        out = bgzf.Writer(path)
        out.write(MAGIC + struct.pack("<i", len(text)) + text + struct.pack("<i", len(self.references)))
        for n, k in self.references:
            out.write(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", k))
        out.flush()
        names, tag_bytes = pa.array([n for n, _ in self.references], pa.string()), {}
        index, before, ordered = bgzf.Index(len(self.references)), -1, True
        for batch in iterator:
            for b in cut(batch):
                data, size, ref, start, end, places = packed(b, names, tag_bytes)
                order = np.concatenate(([before], (np.where(ref >= 0, ref, len(names)) << 40) + b["pos0"].to_numpy()))
                ordered, before = ordered and bool((np.diff(order) >= 0).all()), int(order[-1])
                first, last = out.write_all(data.tobytes(), np.cumsum(size))
                if ordered:
                    index.add_all(ref, start, end, places, first, last)
        out.close()
        if ordered:
            fs, at = bgzf.located(f"{path}.bai")
            with fs.open_output_stream(at) as f:
                f.write(INDEX_MAGIC + index.body())
        return Written([path, f"{path}.bai"] if ordered else [path])

    def commit(self, messages):
        for path in self.old:
            fs, at = bgzf.located(path)
            fs.delete_file(at)

    def abort(self, messages):
        for m in messages:
            for path in m.paths if m else []:
                fs, at = bgzf.located(path)
                fs.delete_file(at)


class Bam(DataSource):
    """Options to read: path (a file or folder), split (compressed bytes a task). To write: path, references (JSON: [[name, length], ...])."""

    @classmethod
    def name(cls):
        return "bam"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return Alignments(schema, dict(self.options))

    def writer(self, schema, overwrite):
        return AlignmentWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with filters pushed to it, wherever its Python workers were started."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Bam)
