"""Variant calls and alignments of text as data sources: spark.read.format("vcf"), spark.read.format("sam").

Files are read in stretches of bytes, or of gzip blocks, one to a task. A filter on name and place goes to the file's index where it has
one, else to the lines before they are taken apart. Of a VCF's INFO only the fields of the schema that is given are looked for. Call
register(spark) first.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as csv
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from helixtab.sources import bgzf, lines
from helixtab.sources.bam import Written, cut, whole
from helixtab.sources.regions import Region

#: Fixed values of the formats: leading columns, types by the header's names, the index's head.
FIXED = ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")
TYPES = {"Integer": "long", "Float": "double", "Flag": "boolean", "String": "string", "Character": "string"}
INDEX_MAGIC, VCF_INDEX = b"TBI\1", (2, 1, 2, 0, ord("#"), 0)
ENDS = (".vcf", ".vcf.gz", ".vcf.bgz")
SAM_COLUMNS = ("read_name", "flag", "chrom", "pos0", "mapq", "cigar", "mate_chrom", "mate_pos0", "insert_size", "query", "quals")
SAM_SCHEMA = "sample string, read_name string, flag int, chrom string, pos0 long, mapq int, cigar string, mate_chrom string, mate_pos0 long, insert_size int, query string, quals string, tags map<string, string>"


def head(path: str, mark: bytes) -> list[str]:
    """The lines of a file's head: those before the first that doesn't start with mark."""
    out: list[str] = []
    for text in lines.read(lines.Stretch(path, "gzip" if path.endswith((".gz", ".bgz")) else "bytes", 0, 1 << 62)):
        for line in text.split(b"\n")[:-1]:
            if not line.startswith(mark):
                return out
            out.append(line.decode())
    return out


def vcf_schema(header: list[str]) -> tuple[str, list[str]]:
    """(schema, columns of the file): the fixed columns, an INFO_x for each declared field, FORMAT and the samples."""
    declared = []
    for line in header:
        if m := re.match(r"##INFO=<ID=([^,]+),Number=([^,]+),Type=([^,>]+)", line):
            kind = TYPES.get(m[3], "string")
            declared.append(f"`INFO_{m[1]}` {kind if m[2] in '01' or kind == 'boolean' else f'array<{kind}>'}")
    columns = header[-1].lstrip("#").split("\t")
    rest = [f"`{c}` string" for c in columns[8:]]
    return ", ".join(["CHROM string, POS long, ID string, REF string, ALT string, QUAL string, FILTER string, INFO string", *declared, *rest]), columns


def info_values(info: pa.Array, name: str, kind: pa.DataType) -> pa.Array:
    """A field of INFO texts; null where it is missing or '.'."""
    if pa.types.is_boolean(kind):
        return pc.match_substring_regex(info, f"(^|;){re.escape(name)}(=|;|$)")
    found = pc.struct_field(pc.extract_regex(info, f"(?:^|;){re.escape(name)}=(?P<v>[^;]*)"), "v")
    found = pc.if_else(pc.is_in(found, pa.array([".", ""])), None, found)
    if pa.types.is_list(kind):
        parts = pc.split_pattern(found, ",")
        values = pc.if_else(pc.equal(parts.values, "."), None, parts.values).cast(kind.value_type)
        return pa.ListArray.from_arrays(parts.offsets, values, mask=pc.is_null(found) if found.null_count else None).cast(kind)
    return found.cast(kind)


class TextReader(DataSourceReader):
    """Stretches of lines; what filters ask of name and place is seen to before lines are taken apart."""

    ends: tuple[str, ...] = ()

    def __init__(self, schema: StructType, options: dict, region: Region):
        self.schema, self.options, self.region = schema, options, region

    def pushFilters(self, filters):
        for f in filters:
            self.region.add(f)
        yield from filters

    def index(self, path: str):
        return None

    def partitions(self):
        split, out = int(self.options.get("split", lines.SPLIT)), []
        for path, size in bgzf.listed(self.options["path"], self.ends):
            found = self.index(path) if self.region.bounded() else None
            if found is None:
                out += lines.planned(path, size, split)
                continue
            names, index = found
            for number, name in enumerate(names):
                low, high = self.region.of(name, 1 << 29)
                if low < high:
                    out += [lines.Stretch(path, "records", a, b) for a, b in index.chunks(number, low, high)]
        return out or [lines.Stretch("", "bytes", 0, 0)]

    def _asked(self, name: pa.Array, start: pa.Array) -> pa.Array:
        """Which rows the filters may keep."""
        good = pc.and_(pc.greater_equal(start, self.region.least), pc.less_equal(start, self.region.most))
        return good if self.region.names is None else pc.and_(good, pc.is_in(name, pa.array(sorted(n for n in self.region.names if n is not None), pa.string())))


class VcfReader(TextReader):
    ends = ENDS

    def index(self, path: str):
        packed = bgzf.whole(f"{path}.tbi")
        if not packed:
            return None
        reader, at, data = bgzf.Reader(f"{path}.tbi"), 0, b""
        while at < reader.size:
            text, at = reader.text(at)
            data += text
        n, *_, size = struct.unpack_from("<8i", data, 4)
        return data[36 : 36 + size].decode().split("\0")[:n], bgzf.Index.parse(data, 36 + size, n)

    def read(self, part):
        if not part.path:
            return
        kinds = to_arrow_schema(self.schema)
        columns = vcf_schema(head(part.path, b"#"))[1]
        wanted = {n if n in columns else "INFO" for n in kinds.names} | {"CHROM", "POS"}
        for text in lines.read(part):
            if text.startswith(b"#"):
                at = 0
                while text.startswith(b"#", at):
                    at = text.find(b"\n", at) + 1
                text = text[at:]
            if not text:
                continue
            table = csv.read_csv(
                pa.BufferReader(text), csv.ReadOptions(column_names=columns, block_size=max(len(text), 1)), csv.ParseOptions(delimiter="\t", quote_char=False, double_quote=False),
                csv.ConvertOptions(column_types={c: pa.string() for c in wanted} | {"POS": pa.int64()}, include_columns=[c for c in columns if c in wanted], strings_can_be_null=False),
            )
            table = table.filter(self._asked(table["CHROM"], pc.subtract(table["POS"], self.region.origin)))
            for b in table.combine_chunks().to_batches():
                get = lambda f: b[f.name].cast(f.type) if f.name in columns else info_values(b["INFO"], f.name.removeprefix("INFO_"), f.type)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([get(f) for f in kinds], schema=kinds)


def texts(values: pa.Array) -> pa.Array:
    """Values as texts: lists by commas, '.' for null."""
    kind = values.type
    if pa.types.is_list(kind):
        size = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
        parts = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()), texts(values.flatten()))
        return pc.if_else(pc.is_valid(values), pc.binary_join(parts, ","), pa.array(["."] * len(values)))
    if pa.types.is_string(kind) or pa.types.is_integer(kind):
        return pc.fill_null(values.cast(pa.string()), ".")
    return pa.array(["." if v is None else str(v) for v in values.to_pylist()], pa.string())  # numbers in the shortest form


class VcfWriter(DataSourceArrowWriter):
    """A file of gzip blocks for each task, with an index if its rows are grouped by CHROM and ordered by POS. INFO_x columns that aren't null go to INFO."""

    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.folder, self.header = options["path"], json.loads(options.get("header", "[]"))
        names = [f.name for f in schema.fields]
        self.info = [n for n in names if n.startswith("INFO_")]
        self.samples = [n for n in names if n not in FIXED and n not in self.info]
        fs, at = bgzf.located(self.folder)
        fs.create_dir(at, recursive=True)
        self.old = [p for p, _ in bgzf.listed(self.folder, (*ENDS, ".tbi"))] if overwrite else []

    def write(self, iterator):
        path = f"{self.folder.rstrip('/')}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.vcf.gz"
        columns = [*FIXED[: 9 if self.samples else 8], *self.samples]
        out = bgzf.Writer(path)
        for line in ["##fileformat=VCFv4.2", *self.header, "#" + "\t".join(columns)]:
            out.write((line + "\n").encode())
        out.flush()
        names: dict[str, int] = {}
        index, before, ordered = bgzf.Index(0), -1, True
        for batch in iterator:
            for b in cut(batch):
                if b["POS"].null_count:
                    raise ValueError("a variant has no place")
                data, size = whole(self._lines(b, columns))
                chrom = texts(b["CHROM"]).dictionary_encode()
                number = np.array([names.setdefault(n, len(names)) for n in chrom.dictionary.to_pylist()], np.int64)[chrom.indices.to_numpy()]
                for _ in range(len(names) - len(index.bins)):
                    index.bins.append({}), index.linear.append([])
                place = b["POS"].to_numpy().astype(np.int64) - 1
                order = np.concatenate(([before], (number << 40) + place + 1))
                ordered, before = ordered and bool((np.diff(order) >= 0).all()), int(order[-1])
                first, last = out.write_all(data.tobytes(), np.cumsum(size))
                if ordered:
                    start, length = np.maximum(place, 0), pc.utf8_length(pc.fill_null(b["REF"], "")).to_numpy()
                    end = start + np.maximum(length, 1)
                    index.add_all(number, start, end, bgzf.bins_of(start, end), first, last)
        out.close()
        if ordered:
            listed = b"".join(n.encode() + b"\0" for n in names)
            packed = bgzf.Writer(f"{path}.tbi")
            packed.write(INDEX_MAGIC + struct.pack("<8i", len(names), *VCF_INDEX, len(listed)) + listed + index.body()[4:])
            packed.close()
        return Written([path, f"{path}.tbi"] if ordered else [path])

    def _lines(self, b: pa.RecordBatch, columns: list[str]) -> pa.Array:
        info, none = [], pa.nulls(b.num_rows, pa.string())
        for n in self.info:
            if pa.types.is_boolean(b[n].type):
                info.append(pc.if_else(pc.fill_null(b[n], False), pa.array([n[5:]] * b.num_rows), none))
            else:
                info.append(pc.if_else(pc.is_valid(b[n]), pc.binary_join_element_wise(f"{n[5:]}=", texts(b[n]), ""), none))
        if "INFO" in b.schema.names:
            info.append(pc.if_else(pc.is_in(b["INFO"], pa.array([None, ".", ""], pa.string())), none, b["INFO"].cast(pa.string())))
        nothing = pa.array(["."] * b.num_rows, pa.string())
        fields = [pc.fill_null(pc.binary_join_element_wise(x, ";", ""), "") for x in info]
        joined = pc.utf8_slice_codeunits(pc.binary_join_element_wise(*fields, ""), 0, -1) if fields else nothing
        own = {"INFO": pc.if_else(pc.equal(joined, ""), nothing, joined)}
        cells = [own[c] if c in own else texts(b[c]) if c in b.schema.names else nothing for c in columns]
        return pc.binary_join_element_wise(pc.binary_join_element_wise(*cells, "\t"), "\n", "")

    def commit(self, messages):
        for path in self.old:
            fs, at = bgzf.located(path)
            fs.delete_file(at)

    def abort(self, messages):
        for m in messages:
            for path in m.paths if m else []:
                fs, at = bgzf.located(path)
                fs.delete_file(at)


class SamReader(TextReader):
    ends = (".sam", ".sam.gz", ".txt")

    def read(self, part):
        if not part.path:
            return
        kinds = to_arrow_schema(self.schema)
        sample = re.sub(r"\.(sam|sam\.gz|txt)$", "", part.path.rsplit("/", 1)[-1])
        for text in lines.read(part):
            rows = pa.array([line for line in text.decode().split("\n") if line and not line.startswith("@")], pa.string())
            if not len(rows):
                continue
            cells = pc.split_pattern(pc.binary_join_element_wise(rows, "", "\t"), "\t", max_splits=11)  # a twelfth for tags, though there may be none
            cell = lambda i: pc.list_element(cells, i)  # noqa: E731, B023
            start = pc.subtract(cell(3).cast(pa.int64()), 1)
            good = self._asked(cell(2), start)
            cells = cells.filter(good)
            out = []
            for f in kinds:
                if f.name == "sample":
                    value = pa.array([sample] * len(cells), pa.string())
                elif f.name == "tags":
                    own = [[t for t in c.split("\t") if t] for c in cell(11).to_pylist()]
                    value = pa.array([[(t[:2], t.split(":", 2)[2]) for t in c] for c in own], pa.map_(pa.string(), pa.string()))
                else:
                    value = cell(SAM_COLUMNS.index(f.name)).cast(f.type)
                    value = pc.subtract(value, 1) if f.name in ("pos0", "mate_pos0") else value
                out.append(value.cast(f.type))
            yield pa.RecordBatch.from_arrays(out, schema=kinds)


class Vcf(DataSource):
    """Options to read: path (a file or folder), split (bytes a task). To write: path, header (JSON: lines)."""

    @classmethod
    def name(cls):
        return "vcf"

    def schema(self):
        path, _ = bgzf.listed(self.options["path"], ENDS)[0]
        return vcf_schema(head(path, b"#"))[0]

    def reader(self, schema):
        return VcfReader(schema, dict(self.options), Region("CHROM", "POS", origin=1))

    def writer(self, schema, overwrite):
        return VcfWriter(schema, dict(self.options), overwrite)


class Sam(DataSource):
    """Options: path (a file or folder), split (bytes a task)."""

    @classmethod
    def name(cls):
        return "sam"

    def schema(self):
        return SAM_SCHEMA

    def reader(self, schema):
        return SamReader(schema, dict(self.options), Region("chrom", "pos0"))


def register(spark: SparkSession) -> None:
    """Make both formats known to a session, with filters pushed to them, wherever its Python workers were started."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Vcf)
    spark.dataSource.register(Sam)
