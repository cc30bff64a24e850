"""Scans and sinks of the pipeline's file formats. Row order is captured where it carries meaning."""

from __future__ import annotations

import csv
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sievemark.functions import sequences as fs
from sievemark.operators.carry import carried_forward


def _pieces(spark: SparkSession, path: str, **how) -> DataFrame:
    """(file, n, value): what a separator parts, and n, which orders it within its file. Large files are split."""
    # Inside a block rows are read in order and numbered upwards; blocks are ordered by where they start.
    n = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    return spark.read.text(path, **how).select(F.url_decode("_metadata.file_name").alias("file"), n.alias("n"), "value")


def _first(pieces: DataFrame) -> DataFrame:
    """(file, first): the number of each file's first piece."""
    return pieces.where("n.block = 0").groupBy("file").agg(F.min("n.id").alias("first"))


def scan_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, header, sequence) of every record; text before the first '>' is ignored, gaps and stops are dropped.

    Files are cut where a line begins with '>', so that a large one is read by many tasks; ord numbers a file's records.
    """
    pieces = _pieces(spark, path, lineSep="\n>")
    pieces = pieces.join(F.broadcast(_first(pieces)), "file", "left")  # a row a file
    # A file's first piece has its own '>', if any, after a byte order mark and whatever else stands there.
    opened = (F.col("n.block") == 0) & (F.col("n.id") == F.col("first"))
    said = F.when(opened, F.regexp_replace("value", "^\\uFEFF", "")).otherwise(F.concat(F.lit(">"), "value"))
    records = pieces.select("file", "n", F.posexplode(F.split(said, r"(?m)^[^\S\n]*>")).alias("at", "piece")).where("at > 0")
    parts = F.split("piece", r"\r?\n", 2)
    sequence = F.upper(F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"[\s*-]", ""))
    records = records.select("file", F.col("n.block").alias("block"), "n", "at", F.trim(parts[0]).alias("header"), sequence.alias("sequence"))
    # Numbers inside each block, and how many records the blocks before it have.
    inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("n", "at"))
    sizes = records.groupBy("file", "block").agg(F.count("*").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = records.withColumn("inside", inside).join(sizes.select("file", "block", before.alias("before")), ["file", "block"])
    return numbered.select("file", (F.col("before") + F.col("inside")).alias("ord"), "header", "sequence")


def scan_input_dir(spark: SparkSession, folder: str, extensions: tuple[str, ...] = ("fasta", "fa", "faa")) -> DataFrame:
    """Records of the folder's own files with one of the extensions, in any case; input_ord numbers them by file name, then place."""
    rows = scan_fasta(spark, folder).where(F.lower(F.regexp_extract("file", r"\.([^.]+)$", 1)).isin(*extensions))
    sizes = rows.groupBy("file").agg(F.max("ord").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a file
    return rows.join(F.broadcast(sizes.select("file", before.alias("before"))), "file").withColumn("input_ord", F.col("before") + F.col("ord")).drop("before")


def sink_fasta(rows: DataFrame, path: str, width: int = 60) -> None:
    """rows (header, sequence) as FASTA; width 0 writes one line a sequence."""
    rows.select(_record(width)).write.text(path)


def _record(width: int) -> Column:
    body = F.regexp_replace("sequence", f"(.{{{width}}})(?!$)", "$1\n") if width else F.col("sequence")
    return F.concat(F.lit(">"), "header", F.lit("\n"), body)


def scan_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A tab-separated table with a header; a missing path is an empty table."""
    try:
        return spark.read.csv(path, sep="\t", header=True, schema=schema, quote='"', escape='"', nullValue="")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def as_text(df: DataFrame) -> DataFrame:
    """Values as the tables write them: True and False, numbers with at most six decimals, null as nothing."""
    return df.select(*(text_of(n, k) for n, k in df.dtypes))


def text_of(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind == "boolean":
        return F.initcap(c.cast("string")).alias(name)
    return (fs.number_text(c) if kind in ("double", "float") else F.array_join(c, "|") if kind.startswith("array") else c.cast("string")).alias(name)


def sink_tsv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Exactly these columns in this order; a missing one is empty, others are dropped."""
    full = df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns))
    as_text(full).write.csv(path, sep="\t", header=True, quote='"', escape='"', nullValue="", emptyValue="")


def as_one_file(lines: DataFrame, order: list[str | Column], path: str, head: list[str] = []) -> None:  # noqa: B006
    """lines (value, and what orders them) as one file, in order, behind the lines of head.

    Tasks write the parts, dealt and sorted by ranges; these are then put together, byte by byte, beside the path, which
    the whole file takes at last. A run that fails leaves no file, and parts are gone in any case. A file that is there is an error.
    """
    spark = lines.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    mark = uuid.uuid4().hex
    target, whole, parts = place(path), place(f"{path}.whole-{mark}"), place(f"{path}.parts-{mark}")
    fs_ = target.getFileSystem(conf)
    if fs_.exists(target):
        raise FileExistsError(path)
    try:
        lines.orderBy(*order).select("value").write.text(parts.toString())
        names = sorted(x.getPath().getName() for x in fs_.listStatus(parts) if x.getPath().getName().startswith("part-"))
        out = fs_.create(whole)
        try:
            out.write(bytearray("".join(f"{x}\n" for x in head), "utf-8"))
            for name in names:
                part = fs_.open(place(parts, name))
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                finally:
                    part.close()
        finally:
            out.close()
        if not fs_.rename(whole, target):
            raise OSError(f"cannot write {path}")
    finally:
        fs_.delete(whole, False)
        fs_.delete(parts, True)


def sink_tsv_file(df: DataFrame, order: list[str], path: str, columns: list[str]) -> None:
    """sink_tsv as one file with one header, its rows in order."""
    full = df.select(*order, *((F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(f"__c{i}") for i, c in enumerate(columns)))
    kinds = dict(full.dtypes)
    rows = full.select(*order, F.struct(*(text_of(c, kinds[c]) for c in (f"__c{i}" for i in range(len(columns))))).alias("r"))
    line = F.to_csv("r", {"sep": "\t", "quote": '"', "escape": '"', "nullValue": "", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    as_one_file(rows.select(*order, line.alias("value")), order, path, ["\t".join(columns)])


def sink_fasta_file(rows: DataFrame, order: list[str], path: str, width: int = 60) -> None:
    """sink_fasta as one file, its records in order."""
    as_one_file(rows.select(*order, _record(width).alias("value")), order, path)


def sniff(head: str) -> str:
    """Tab, comma or semicolon, whichever is most frequent; earlier ones win ties."""
    return max("\t,;", key=lambda d: (head.count(d), -"\t,;".index(d)))


def resolve_column(columns: list[str], candidates: list[str], what: str, required: bool = True) -> str | None:
    """The first candidate that a column equals, begins with or contains, letters and digits alone compared."""
    plain = {c: re.sub(r"[^a-z0-9]", "", c.lower()) for c in columns}
    for test in (lambda have, want: have == want, lambda have, want: have.startswith(want), lambda have, want: want in have):
        for wanted in candidates:
            key = re.sub(r"[^a-z0-9]", "", wanted.lower())
            for name, have in plain.items():
                if key and test(have, key):
                    return name
    if required:
        raise ValueError(f"no column for {what} ({', '.join(candidates)}) among {', '.join(columns)}")
    return None


def to_float(x: Column, what: str) -> Column:
    """A number, or an error that says what was none."""
    return F.coalesce(F.trim(x).try_cast("double"), F.raise_error(F.concat(F.lit(f"no number for {what}: "), F.coalesce(x, F.lit("(nothing)")))).cast("double"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, line); n orders the lines of a file."""
    return _pieces(spark, path).select("file", "n", F.regexp_replace("value", "^\\uFEFF", "").alias("line"))


#: Characters of a file from which its delimiter is guessed.
SAMPLE = 8192


def _delimiters(lines: DataFrame) -> dict[str, str]:
    """The delimiter of each file, from its first lines."""
    first = F.broadcast(_first(lines))  # a row a file
    size = F.length("line") + 1
    near = lines.where("n.block = 0").join(first, "file").where(F.col("n.id") < F.col("first") + SAMPLE)
    upto = F.sum(size).over(Window.partitionBy("file").orderBy("n")) - size
    head = near.withColumn("upto", upto).where(F.col("upto") < SAMPLE).select("file", "n", F.left("line", SAMPLE - F.col("upto").cast("int")).alias("line"))
    texts: dict[str, str] = {}
    for r in head.orderBy("file", "n").collect():
        texts[r.file] = texts.get(r.file, "") + r.line + "\n"
    return {f: sniff(x) for f, x in texts.items()}


def scan_delimited(spark: SparkSession, path: str, header_contains: str = "") -> DataFrame:
    """The tables of a path's files, each of its own delimiter; ragged rows are filled or cut, blank rows go.

    With header_contains a file's header is the first row that has a field of that name, in any case; what stands
    before is a preamble. Without, it is the first row. __file and __row say where a row comes from, in order.
    """
    lines = numbered_lines(spark, path)
    seps = _delimiters(lines)
    if not seps:
        return spark.createDataFrame([], T.StructType())
    # One small row a file: reports of tools.
    known = F.broadcast(spark.createDataFrame(list(seps.items()), "file string, sep string"))
    filled = lines.where(F.length(F.trim("line")) > 0).join(known, "file")
    wanted = header_contains.strip().lower()
    fields = F.transform(F.split("line", F.concat(F.lit("\\Q"), F.col("sep"), F.lit("\\E"))), lambda x: F.trim(F.lower(F.trim(x)), F.lit('"')))
    heads = (filled.where(F.array_contains(fields, wanted)) if wanted else filled).groupBy("file", "sep").agg(F.min(F.struct("n", "line")).alias("h")).select("file", "sep", "h.n", "h.line").collect()
    if wanted and len(heads) < len(seps):
        raise ValueError(f"no header with a field {header_contains!r} in {', '.join(sorted(set(seps) - {h.file for h in heads}))}")
    tables: dict[tuple[str, ...], list] = {}
    for h in heads:
        names = [x.strip() for x in next(csv.reader([h.line], delimiter=h.sep))]
        names = [x or f"_c{i}" for i, x in enumerate(names)]
        # Of columns with one name the last has it.
        names = [x if x not in names[i + 1 :] else f"{x}#{i}" for i, x in enumerate(names)]
        tables.setdefault((h.sep, *names), []).append(h)
    out = None
    for (sep, *names), own in tables.items():
        schema = ", ".join("`" + x.replace("`", "``") + "` string" for x in names)
        starts = F.broadcast(spark.createDataFrame([(h.file, h.n) for h in own], lines.select("file", F.col("n").alias("head")).schema))
        # Exploded, so that no later filter on a cell is moved before this one and meets the header or the preamble.
        rows = filled.join(starts, "file").select("file", "n", F.explode(F.when(F.col("n") > F.col("head"), F.array("line"))).alias("body"))
        rows = rows.select("file", "n", F.from_csv("body", F.lit(schema), {"sep": sep, "escape": '"'}).alias("r")).select(F.col("file").alias("__file"), F.col("n").alias("__row"), "r.*")
        rows = rows.where(F.exists(F.array(*(F.col("`" + x.replace("`", "``") + "`") for x in names)), lambda x: F.length(F.trim(F.coalesce(x, F.lit("")))) > 0))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return spark.createDataFrame([], T.StructType()) if out is None else out


def scan_alleles(spark: SparkSession, path: str) -> DataFrame:
    """(n, allele): one a line, comments and blank lines left out; a file without any is an error."""
    rows = numbered_lines(spark, path).select("n", F.trim(F.split("line", "#")[0]).alias("allele")).where("allele <> ''")
    if rows.isEmpty():
        raise ValueError(f"no alleles in {path}")
    return rows


def scan_sections(spark: SparkSession, path: str) -> DataFrame:
    """(sequence_id, position, residue, score) of a sectioned table: '>id' opens a block of rows, tabs or commas part their cells.

    Rows whose first cell is no whole number are headings; scores before any '>' are an error.
    """
    lines = numbered_lines(spark, path).select("file", "n", F.trim("line").alias("line")).where("line <> ''")
    own = F.when(F.startswith("line", F.lit(">")), F.split(F.trim(F.expr("substr(line, 2)")), r"\s+")[0])
    lines = carried_forward(lines, ["file"], F.col("n.block"), F.col("n"), {"sequence_id": own}).where("not startswith(line, '>')")
    cells = F.split("line", F.when(F.contains("line", F.lit("\t")), "\t").otherwise(","))
    rows = lines.withColumn("c", cells).where((F.size("c") >= 3) & F.trim(F.col("c")[0]).rlike("^-*[0-9]+$"))
    named = F.coalesce("sequence_id", F.raise_error(F.concat(F.lit("scores before any '>' in "), "file")).cast("string"))
    return rows.select(named.alias("sequence_id"), F.trim(F.col("c")[0]).cast("long").alias("position"), F.trim(F.col("c")[1]).alias("residue"), to_float(F.col("c")[2], "score").alias("score"))


def scan_residue_scores(spark: SparkSession, path: str) -> DataFrame:
    """The plug-in contract of any per-residue predictor: sequence_id, position, score."""
    return spark.read.csv(path, sep="\t", header=True, schema="sequence_id string, position long, score double")


def sink_residue_scores(track: DataFrame, path: str) -> None:
    track.select("sequence_id", "position", "score").repartitionByRange("sequence_id").sortWithinPartitions("sequence_id", "position").write.csv(path, sep="\t", header=True)


def first_token(x: Column) -> Column:
    """An identifier without leading '>' and what follows it."""
    return F.split(F.trim(F.ltrim(F.trim(x), F.lit(">"))), r"\s+")[0]


def scan_wide_residues(spark: SparkSession, path: str, ids: list[str], scores: list[str], positions: tuple[str, ...] = ()) -> DataFrame:
    """(sequence_id, position, score) of a table with a row a residue, numbered by its position column or else in file order."""
    rows = scan_delimited(spark, path)
    if not rows.columns:
        raise ValueError(f"no rows in {path}")
    columns = [c for c in rows.columns if c not in ("__file", "__row")]
    name, value = resolve_column(columns, ids, "id"), resolve_column(columns, scores, "score")
    place = resolve_column(columns, list(positions), "position", required=False)
    order = ([to_float(F.col(f"`{place}`"), "position").cast("int")] if place else []) + [F.col("__file"), F.col("__row")]
    by = Window.partitionBy("sequence_id").orderBy(*order)
    rows = rows.withColumn("sequence_id", first_token(F.col(f"`{name}`")))
    return rows.select("sequence_id", F.row_number().over(by).cast("long").alias("position"), to_float(F.col(f"`{value}`"), "score").alias("score"))


def last_rows(rows: DataFrame, key: str) -> DataFrame:
    """Of the rows with one key, the last of the path's files."""
    rest = [c for c in rows.columns if c not in (key, "__file", "__row")]
    return rows.groupBy(key).agg(F.max(F.struct("__file", "__row", *rest)).alias("r")).select(key, *(F.col(f"r.`{c}`") for c in rest))


def scan_scores(spark: SparkSession, path: str, ids: list[str], scores: list[str], unscored: tuple[str, ...] = (), header_contains: str = "") -> DataFrame:
    """(sequence_id, score): sentinels read as null, present but unscored; other text that is no number is an error. The last row of an id counts."""
    rows = scan_delimited(spark, path, header_contains)
    if not rows.columns:
        raise ValueError(f"no rows in {path}")
    columns = [c for c in rows.columns if c not in ("__file", "__row")]
    name, value = resolve_column(columns, ids, "id"), resolve_column(columns, scores, "score")
    raw = F.trim(F.coalesce(F.col(f"`{value}`"), F.lit("")))
    score = F.when(F.lower(raw).isin(*unscored), None).otherwise(to_float(raw, "score")) if unscored else to_float(raw, "score")
    rows = rows.where(F.length(F.trim(f"`{name}`")) > 0).select("__file", "__row", first_token(F.col(f"`{name}`")).alias("sequence_id"), score.alias("score"))
    return last_rows(rows, "sequence_id")


def must_cover(asked: DataFrame, given: DataFrame, key: str) -> None:
    """Every id asked for must have come back: one that is missing has an unknown result, not a clean one."""
    missing = [r[0] for r in asked.join(given, key, "left_anti").select(key).orderBy(key).limit(10).collect()]
    if missing:
        raise ValueError(f"no result for {', '.join(map(str, missing))}")


def scan_population_report(spark: SparkSession, path: str) -> DataFrame:
    """(population, mhc_class, coverage, average_hit, pc90) of a report in blocks of class I, II and combined.

    A block has two tables whose headings begin alike; the one whose second cell is 'coverage' counts, up to a
    blank line. Rows need a coverage; their other cells may be missing. A report without rows is an error.
    """
    line = F.trim("line")
    cells = F.filter(F.transform(F.split(line, F.when(F.contains(line, F.lit("\t")), "\t").otherwise(r"\s{2,}")), lambda x: F.trim(x)), lambda x: x != "")
    lines = numbered_lines(spark, path).select("file", "n", line.alias("line"), F.lower(line).alias("low"), cells.alias("c"))
    is_class, is_head = F.startswith("low", F.lit("class ")), F.startswith("low", F.lit("population"))
    kind = F.when(is_class, F.trim(F.expr("substr(line, 7)")))
    head = F.when(is_class | (F.col("line") == ""), False).when(is_head, F.coalesce(F.lower(F.get("c", F.lit(1))) == "coverage", F.lit(False)))
    marked = carried_forward(lines, ["file"], F.col("n.block"), F.col("n"), {"mhc_class": kind, "inside": head}).where(head.isNull()).withColumn("mhc_class", F.coalesce("mhc_class", F.lit("")))
    number = lambda i: F.get("c", F.lit(i)).try_cast("double")
    rows = marked.where("inside and size(c) >= 2").where(~F.lower(F.col("c")[0]).isin("average", "standard_deviation"))
    rows = rows.select(F.col("c")[0].alias("population"), "mhc_class", F.trim(F.replace(F.col("c")[1], F.lit("%"), F.lit(""))).try_cast("double").alias("coverage"), number(2).alias("average_hit"), number(3).alias("pc90")).where("coverage is not null")
    if rows.isEmpty():
        raise ValueError(f"no population rows in {path}")
    return rows


def sink_population_input(rows: DataFrame, path: str) -> None:
    """rows (peptide, alleles): a line 'peptide<TAB>a,b,c'; peptides without alleles are left out."""
    said = F.array_join(F.array_sort(F.array_distinct("alleles")), ",")
    rows.where(F.size("alleles") > 0).select(F.concat("peptide", F.lit("\t"), said)).write.text(path)
