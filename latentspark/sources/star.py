"""STAR particle metadata: blocks of loops whose headers name the columns.

``spark.read.format("star")`` is a Python data source. A document (a file, or the files of a folder in name order)
is cut into byte ranges; a first pass counts the records of every range and finds the headers in it, so that the
second pass knows for each range which block it is in and which position its first record has. Positions come
without a sort or a shuffle, one small row per range comes to the driver, and no record does.

A particle file of several blocks is one relation: ``read_particles`` joins every particle to its optics group and
``particles_from_star`` brings units together (shifts in Å become pixels by the group's pixel size).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from latentspark.operators.particles import CTF_COLUMNS
from latentspark.operators.position import with_position
from latentspark.session import broadcast_if_small

# STAR labels of the particle and optics columns.
IMAGE_LABEL = "_rlnImageName"
COORD_LABELS = {"x": "_rlnCoordinateX", "y": "_rlnCoordinateY"}
ANGLE_LABELS = {"rot": "_rlnAngleRot", "tilt": "_rlnAngleTilt", "psi": "_rlnAnglePsi"}
SHIFT_LABELS = {"shift_x": "_rlnOriginX", "shift_y": "_rlnOriginY"}
ANGSTROM_LABELS = {"shift_x": "_rlnOriginXAngst", "shift_y": "_rlnOriginYAngst"}
POSE_LABELS = ANGLE_LABELS | SHIFT_LABELS
DEFOCUS_LABELS = {"defocus_u": "_rlnDefocusU", "defocus_v": "_rlnDefocusV", "defocus_angle": "_rlnDefocusAngle"}
OPTICS_LABELS = {
    "box": "_rlnImageSize",
    "apix": "_rlnImagePixelSize",
    "voltage": "_rlnVoltage",
    "spherical_aberration": "_rlnSphericalAberration",
    "amplitude_contrast": "_rlnAmplitudeContrast",
}
GROUP_LABEL = "_rlnOpticsGroup"
DETECTOR_LABEL, MAGNIFICATION_LABEL = "_rlnDetectorPixelSize", "_rlnMagnification"
BLOCK_NAME = "data_particles"
OPTICS_BLOCK = "data_optics"
# End of fixed values.

NUMERIC_LABELS = frozenset([
    *COORD_LABELS.values(), *POSE_LABELS.values(), *ANGSTROM_LABELS.values(), *DEFOCUS_LABELS.values(),
    *OPTICS_LABELS.values(), GROUP_LABEL, DETECTOR_LABEL, MAGNIFICATION_LABEL])
RANGE_BYTES = 64 << 20
_READ_BYTES = 8 << 20
_HEADER = re.compile(rb"^[ \t]*(data_\S*|loop_|_\S+(?:[ \t]+#\d+)?)[ \t\r]*$", re.M)
_RECORD = re.compile(rb"^[ \t\r]*[^\s#][^\n]*", re.M)


@dataclass
class Range:
    """Bytes of a file; lines belong to the range in which they begin."""

    path: str
    start: int
    end: int


@dataclass
class Section:
    """What a range holds of one block: lines of its header, and its records. The first one of a range goes on
    with the block before and has no name."""

    name: str | None = None
    labels: list[str] = field(default_factory=list)
    records: int = 0


def _storage(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")


def _pieces(part: Range) -> Iterator[bytes]:
    """Whole lines of a range, some megabytes at a time."""
    store, path = _storage(part.path)
    with store.open_input_file(path) as file:
        size, at, rest = file.size(), part.start, b""
        if at:  # the line that runs into the range belongs to the one before
            at -= 1
            while at < size:
                data = file.read_at(_READ_BYTES, at)
                cut = data.find(b"\n")
                if cut >= 0:
                    at += cut + 1
                    break
                at += len(data)
        while at < size and at - len(rest) < part.end:
            data = file.read_at(min(_READ_BYTES, size - at), at)
            at += len(data)
            data = rest + data
            first = at - len(data)
            if at >= part.end or at >= size:
                # The last line that begins in the range may end beyond it.
                cut = data.find(b"\n", max(0, part.end - 1 - first))
                if cut < 0 and at < size:
                    rest = data
                    if first >= part.end:
                        break
                    continue
                yield data if cut < 0 else data[:cut + 1]
                return
            cut = data.rfind(b"\n") + 1
            rest = data[cut:]
            if cut:
                yield data[:cut]


def _sections(data: bytes) -> Iterator[tuple[bytes | None, bytes]]:
    """A header line, or None at first, and the lines after it."""
    before, header = 0, None
    for found in _HEADER.finditer(data):
        yield header, data[before:found.start()]
        header, before = found[1], found.end()
    yield header, data[before:]


def scan_range(part: Range) -> list[Section]:
    """Headers and number of records of a range, in order."""
    out = [Section()]
    for data in _pieces(part):
        for header, lines in _sections(data):
            if header is not None and header.startswith(b"data_"):
                out.append(Section(header.decode()))
            elif header is not None and header.startswith(b"_"):
                out[-1].labels.append(header.split()[0].decode())
            out[-1].records += sum(1 for _ in _RECORD.finditer(lines))
    return out


@dataclass
class Layout:
    """Columns of a block, and for each range the base positions of its sections that are of the block."""

    labels: list[str]
    parts: list[tuple[Range, dict[int, int]]]


def plan(ranges: Sequence[Range], scans: Sequence[Sequence[Section]], block: str | None) -> Layout:
    """Where the records of a block lie; ``block`` defaults to the particles, or to the last there is."""
    names = [s.name for scan in scans for s in scan if s.name]
    wanted = block or (BLOCK_NAME if BLOCK_NAME in names else names[-1] if names else None)
    layouts, parts, current, position = [], [], None, 0
    for part, scan in zip(ranges, scans):
        bases = {}
        for i, section in enumerate(scan):
            current = section.name or current
            if current != wanted or wanted is None:
                continue
            if section.name:
                layouts.append([])
            layouts[-1] += section.labels
            if section.records:
                bases[i] = position
            position += section.records
        if bases:
            parts.append((part, bases))
    if len({tuple(found) for found in layouts}) != 1:
        raise ValueError(f"expected one header layout for {wanted}, found {len({tuple(x) for x in layouts})}")
    return Layout(layouts[0], parts)


def _numbers(words: list[str | None]) -> pa.Array:
    """Numbers, null where a word is none."""
    column = pa.array(words, pa.string())
    try:
        return pc.cast(column, pa.float64())
    except pa.ArrowInvalid:
        number = re.compile(r"[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|nan|inf(inity)?)", re.I).fullmatch
        return pa.array([float(w) if w is not None and number(w) else None for w in words], pa.float64())


def read_range(part: Range, bases: dict[int, int], labels: Sequence[str], schema: StructType) -> Iterator[pa.RecordBatch]:
    """Rows of the sections in ``bases``; only columns of ``schema`` are taken out of a record."""
    at, section, position = [labels.index(f.name) if f.name != "position" else -1 for f in schema.fields], 0, bases.get(0)
    for data in _pieces(part):
        for header, lines in _sections(data):
            if header is not None and header.startswith(b"data_"):
                section += 1
                position = bases.get(section)
            if position is None:
                continue
            records = [found[0].decode().split() for found in _RECORD.finditer(lines)]
            if not records:
                continue
            columns = []
            for i, f in zip(at, schema.fields):
                if i < 0:
                    columns.append(pa.array(range(position, position + len(records)), pa.int64()))
                    continue
                words = [r[i] if i < len(r) else None for r in records]
                columns.append(_numbers(words) if isinstance(f.dataType, DoubleType) else pa.array(words, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])
            position += len(records)


def _cut(files: Sequence[tuple[str, int]], size: int) -> list[Range]:
    return [Range(path, at, min(at + size, length)) for path, length in files for at in range(0, max(length, 1), size)]


class _Part(InputPartition):
    def __init__(self, part: Range, bases: dict[int, int]):
        self.part, self.bases = part, bases


class _Reader(DataSourceReader):
    def __init__(self, layout: Layout, schema: StructType):
        self.layout, self.schema = layout, schema

    def partitions(self) -> list[_Part]:
        return [_Part(part, bases) for part, bases in self.layout.parts] or [_Part(Range("", 0, 0), {})]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        return read_range(partition.part, partition.bases, self.layout.labels, self.schema) if partition.bases else iter(())


class StarSource(DataSource):
    """``spark.read.format("star")``: options ``path``, ``block``, ``range_bytes``; a given schema prunes columns.

    ``read_star`` finds the headers by a Spark job and hands the plan over in the option ``plan``. Without it
    planning reads the document itself, which is meant for files of ordinary size.
    """

    @classmethod
    def name(cls) -> str:
        return "star"

    def _layout(self) -> Layout:
        if not hasattr(self, "_found"):
            if "plan" in self.options:
                given = json.loads(self.options["plan"])
                self._found = Layout(given["labels"], [
                    (Range(*part), {int(k): v for k, v in bases.items()}) for part, bases in given["parts"]])
            else:
                from pyarrow import fs

                store, base = _storage(self.options["path"])
                info = store.get_file_info(base)
                files = [info] if info.is_file else sorted(
                    (f for f in store.get_file_info(fs.FileSelector(base)) if f.is_file and not f.base_name.startswith(("_", "."))),
                    key=lambda f: f.path)
                scheme = self.options["path"].split(":")[0] + "://" if ":" in self.options["path"] else ""
                ranges = _cut([(scheme + f.path, f.size) for f in files], int(self.options.get("range_bytes", RANGE_BYTES)))
                self._found = plan(ranges, [scan_range(r) for r in ranges], self.options.get("block"))
        return self._found

    def schema(self) -> StructType:
        return star_schema(self._layout().labels, NUMERIC_LABELS)

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self._layout(), schema)


def star_schema(labels: Sequence[str], numeric) -> StructType:
    """``position`` and the labels, as numbers or text."""
    return StructType([StructField("position", LongType())] + [
        StructField(c, DoubleType() if c in numeric else StringType()) for c in labels])


def _scans(spark: SparkSession, path: str, range_bytes: int) -> tuple[list[Range], list[list[Section]]]:
    """Byte ranges of a document, and what each holds: one row per range comes to the driver."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").orderBy("path").collect()
    ranges = _cut([(r["path"], r["length"]) for r in files], range_bytes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = scan_range(Range(row["path"], row["start"], row["end"]))
                yield pa.RecordBatch.from_pydict({"i": pa.array([row["i"]], pa.int64()), "found": pa.array([json.dumps(
                    [[s.name, s.labels, s.records] for s in found])], pa.string())})

    rows = spark.createDataFrame([(i, r.path, r.start, r.end) for i, r in enumerate(ranges)],
                                 "i bigint, path string, start bigint, end bigint")
    found = rows.repartition(max(1, min(len(ranges), 4096)), "i").mapInArrow(scan, "i bigint, found string").collect()
    return ranges, [[Section(*s) for s in json.loads(r["found"])] for r in sorted(found, key=lambda r: r["i"])]


def read_star(
    spark: SparkSession, path: str, *, block: str | None = None, numeric: Sequence[str] | None = None,
    columns: Sequence[str] | None = None, range_bytes: int = RANGE_BYTES, scans=None,
) -> DataFrame:
    """Records of one loop block as ``(position, <labels>)`` in record order.

    ``path`` is a file or a folder of files that are read on as one document in name order. ``block`` defaults to
    ``data_particles``, or the last block there is. ``columns`` prunes: other words of a record are not kept.
    Labels of known meaning are numbers; other columns become numbers where every value is one, or as named by
    ``numeric``. A header is ``data_...`` or ``loop_`` alone, or a label alone or with its ``#`` number: a record
    may begin with ``data_`` or ``_`` as long as it has a second column. Missing words are null.
    """
    ranges, found = scans or _scans(spark, path, range_bytes)
    layout = plan(ranges, found, block)
    labels = [c for c in layout.labels if columns is None or c in columns]
    spark.dataSource.register(StarSource)
    given = json.dumps({"labels": layout.labels, "parts": [
        ([r.path, r.start, r.end], bases) for r, bases in layout.parts]})

    def load(kinds) -> DataFrame:
        return spark.read.format("star").schema(star_schema(labels, kinds)).option("plan", given).load(path)

    if numeric is not None:
        return load(set(numeric))
    known = NUMERIC_LABELS.intersection(labels)
    unknown = [c for c in labels if c not in known]
    if unknown:
        text = load(known)
        checks = text.agg(*[F.coalesce(F.bool_and(F.col(f"`{c}`").try_cast("double").isNotNull()), F.lit(False)).alias(f"c{i}")
                            for i, c in enumerate(unknown)]).first()
        known = known | {c for c, number in zip(unknown, checks) if number}
    return load(known)


def read_particles(spark: SparkSession, path: str, *, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Particles with the columns of their optics group, found by one scan of the document.

    A label that the particles have themselves is taken from them. A particle whose group is not listed has nulls.
    A document without optics has the particles' columns only.
    """
    scans = _scans(spark, path, options.pop("range_bytes", RANGE_BYTES))
    particles = read_star(spark, path, block=None, columns=columns and [*columns, GROUP_LABEL], scans=scans, **options)
    if not any(s.name == OPTICS_BLOCK for scan in scans[1] for s in scan) or GROUP_LABEL not in particles.columns:
        return particles
    optics = read_star(spark, path, block=OPTICS_BLOCK, scans=scans)
    added = [c for c in optics.columns if c not in particles.columns and (columns is None or c in columns)]
    optics = optics.select(GROUP_LABEL, *[F.col(f"`{c}`") for c in added]).where(F.col(GROUP_LABEL).isNotNull()).dropDuplicates([GROUP_LABEL])
    return particles.join(broadcast_if_small(optics), GROUP_LABEL, "left")


def particles_from_star(table: DataFrame) -> DataFrame:
    """Particle columns out of a STAR table; parts without labels are NULL.

    Shifts are in pixels: those given in Å are divided by the particle's pixel size. The pixel size is the optics
    group's, or that of detector and magnification.
    """
    have = set(table.columns)

    def number(label: str) -> Column:
        return F.col(f"`{label}`").cast("double") if label in have else F.lit(None).cast("double")

    def part(values: dict[str, Column], present: bool) -> Column:
        if not present:
            return F.lit(None).cast(f"struct<{', '.join(f'{name}: double' for name in values)}>")
        known = ~F.isnan(F.greatest(*values.values()))
        complete = F.lit(True)
        for value in values.values():
            complete = complete & value.isNotNull()
        return F.when(known & complete, F.struct(*[v.alias(name) for name, v in values.items()]))

    apix = number(OPTICS_LABELS["apix"])
    if {DETECTOR_LABEL, MAGNIFICATION_LABEL} <= have:
        # Detector pixels are in micrometres.
        apix = F.coalesce(apix, number(DETECTOR_LABEL) * 10_000 / F.nullif(number(MAGNIFICATION_LABEL), F.lit(0.0)))
    pixels, angstrom = set(SHIFT_LABELS.values()) <= have, set(ANGSTROM_LABELS.values()) <= have
    shifts = {name: number(label) for name, label in SHIFT_LABELS.items()} if pixels else {
        name: number(label) / F.nullif(apix, F.lit(0.0)) for name, label in ANGSTROM_LABELS.items()}
    pose = {name: number(label) for name, label in ANGLE_LABELS.items()} | shifts
    image = F.col(f"`{IMAGE_LABEL}`")
    location = F.struct(
        F.substring_index(image, "@", 1).cast("int").alias("index"),
        F.substring_index(image, "@", -1).alias("file"))
    optics = {name: number(label) for name, label in (DEFOCUS_LABELS | OPTICS_LABELS).items()} | {"apix": apix}
    optics["box"] = optics["box"].cast("int")
    return table.select(
        "position", location.alias("location"),
        part({name: number(label) for name, label in COORD_LABELS.items()}, set(COORD_LABELS.values()) <= have).alias("coord"),
        part(pose, set(ANGLE_LABELS.values()) <= have and (pixels or angstrom)).alias("transform"),
        *[optics[name].alias(name) for name in CTF_COLUMNS])


def _lines(df: DataFrame, order: int, key: str, fields: Sequence[tuple[str, Column]]) -> DataFrame:
    # A missing number is written as nan, so that every record has all columns.
    values = [F.coalesce(c.cast("string"), F.lit("nan")) for _, c in fields]
    return df.select(F.lit(order).alias("part"), F.col(key).cast("bigint").alias("place"), F.concat_ws(" ", *values).alias("value"))


def _header(spark: SparkSession, order: int, block: str, labels: Sequence[str]) -> DataFrame:
    lines = ["", block, "", "loop_"] + [f"{label} #{i}" for i, label in enumerate(labels, 1)]
    return spark.createDataFrame([(order, i, line) for i, line in enumerate(lines)], "part int, place bigint, value string")


def write_star(df: DataFrame, path: str, with_alignment: bool, *, optics: bool = False) -> None:
    """Write particles in position order, with pose columns only for an aligned set.

    With ``optics`` the set, which has all columns of ``CTF_COLUMNS``, gets an optics block, one row for each
    combination that occurs, the defocus of every particle, and shifts in Å. Lines are sorted by block and place,
    so the part files in name order are one STAR document.
    """
    spark = df.sparkSession
    image = F.format_string("%06d@%s", F.col("location.index"), F.col("location.file"))
    fields = [(IMAGE_LABEL, image)]
    if "coord" in df.columns:
        fields += [(label, F.col(f"coord.{name}")) for name, label in COORD_LABELS.items()]
    if with_alignment:
        fields += [(label, F.col(f"transform.{name}")) for name, label in ANGLE_LABELS.items()]
        fields += [(label, F.col(f"transform.{name}") * F.col("apix")) for name, label in ANGSTROM_LABELS.items()] if optics else [
            (label, F.col(f"transform.{name}")) for name, label in SHIFT_LABELS.items()]
    parts = []
    if optics:
        keys = list(OPTICS_LABELS)
        groups = with_position(df.select(*keys).distinct(), keys[0], keys[1:], position="optics_group").withColumn(
            "optics_group", F.col("optics_group") + 1)
        same = F.lit(True)
        for key in keys:
            same = same & F.col(f"p.{key}").eqNullSafe(F.col(f"g.{key}"))
        df = df.alias("p").join(broadcast_if_small(groups).alias("g"), same).select("p.*", "g.optics_group")
        fields += [(label, F.col(name)) for name, label in DEFOCUS_LABELS.items()] + [(GROUP_LABEL, F.col("optics_group"))]
        of_group = [(GROUP_LABEL, F.col("optics_group"))] + [(label, F.col(name)) for name, label in OPTICS_LABELS.items()]
        parts += [_header(spark, 0, OPTICS_BLOCK, [label for label, _ in of_group]), _lines(groups, 1, "optics_group", of_group)]
    parts += [_header(spark, 2, BLOCK_NAME, [label for label, _ in fields]), _lines(df, 3, "position", fields)]
    document = parts[0]
    for part in parts[1:]:
        document = document.unionByName(part)
    document.orderBy("part", "place").select("value").write.mode("overwrite").text(path)
