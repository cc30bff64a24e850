"""Scans of the outputs of named tools, and the sinks that feed them or report to people.

Raw outputs are read as they are; which column is which is found by name. What a
tool failed to write is an error here, never an empty or a clean result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievemark.functions import sequences as fs
from sievemark.operators.carry import carried_forward, running_sum
from sievemark.operators.identifiers import numbered
from sievemark.sources import files

# Names that the tools' columns go by, the preferred ones first.
ALLELE = ["allele", "mhc", "Allele"]
PEPTIDE = ["peptide", "sequence", "Peptide", "peptide sequence"]
START = ["start", "seq_start", "peptide start", "Peptide start"]
END = ["end", "seq_end", "peptide end", "Peptide end"]
SEQUENCE_NUMBER = ["seq_num", "seq #", "sequence number", "Seq #"]
PERCENTILE = ["percentile_rank", "percentile rank", "rank", "percentile", "el_rank", "ann_percentile", "consensus_percentile_rank"]
BINDING_SCORE = ["score", "el_score", "ic50", "affinity", "Score"]
IMMUNOGENICITY = ["score", "immunogenicity", "Score"]
BEPIPRED_ID = ["Accession", "Entry", "ID", "Protein", "Header", "seq_id", "Sequence ID"]
BEPIPRED_POSITION = ["Residue Position", "Position", "Pos", "Index", "Residue Index", "AA Position"]
BEPIPRED_SCORE = ["BepiPred-3.0 score", "BepiPred-3.0 linear epitope score", "score", "Score", "Prediction", "epitope score"]
EPIDOPE_ID = ["#Header", "Header", "protein", "Protein", "ID", "seq_id", "Accession"]
EPIDOPE_POSITION = ["position", "Position", "pos", "index", "residue_position"]
EPIDOPE_SCORE = ["score", "Score", "epidope_score", "value", "prediction"]
ANTIGENICITY_ID = ["id", "seq_id", "sequence_id", "name", "accession", "header", "protein", "query"]
ANTIGENICITY_SCORE = ["intrinsic_antigenicity_score", "iascore", "ia_score", "score", "iapred", "iapred_score", "prediction", "value", "antigenicity"]
ANTIGENICITY_UNSCORED = ("sequence too short", "invalid sequence", "error", "n/a")
ALLERGENICITY_ID = ["subject", "seq_id", "sequence_id", "id", "name", "header", "query"]
ALLERGENICITY_SCORE = ["hybrid score", "hybrid_score", "combined score", "ml score", "ml_score", "score", "prediction score"]
ALLERGENICITY_CALL = ["prediction", "call", "result", "type"]
# The interchange table of clusters.
CLUSTER_HEADER = ["Cluster.Sub-Cluster Number", "Peptide Number", "Alignment", "Position", "Description", "Peptide"]
CONSENSUS_MARKERS = ("consensus", "consensus sequence")


def _table(spark: SparkSession, path: str, header_contains: str = "") -> tuple[DataFrame, list[str]]:
    rows = files.scan_delimited(spark, path, header_contains)
    return rows, [c for c in rows.columns if c not in ("__file", "__row")]


def _text(name: str) -> Column:
    return F.trim(F.coalesce(F.col(f"`{name}`"), F.lit("")))


def check_binding_header(spark: SparkSession, path: str) -> None:
    """Every file's first line must name allele and peptide. A header alone is a valid result: nothing bound."""
    lines = files.numbered_lines(spark, path)
    heads = _heads(lines)
    if not heads:
        raise ValueError(f"no binding table in {path}: it is empty")
    for file, first, second in heads:
        names = {x.strip().lower() for x in first.split("\t")}
        if not {"allele", "peptide"} <= names:
            raise ValueError(f"no binding table in {file}; it begins with {first[:300]!r}, then {second[:300]!r}")


def _heads(lines: DataFrame) -> list[tuple[str, str, str]]:
    """(file, first line, second line) of each file: a few rows a file."""
    first = lines.where("n.block = 0").groupBy("file").agg(F.min("n.id").alias("first"))
    near = lines.where("n.block = 0").join(F.broadcast(first), "file").where(F.col("n.id") <= F.col("first") + 1)
    out: dict[str, list[str]] = {}
    for r in near.orderBy("file", "n").collect():
        out.setdefault(r.file, []).append(r.line.strip())
    return [(f, x[0], x[1] if len(x) > 1 else "") for f, x in out.items()]


_BINDING = "allele string, peptide string, start int, end int, seq_num int, sequence_id string, percentile double, score double"


def scan_binding(spark: SparkSession, path: str, cutoff: float, ids: DataFrame | None = None) -> DataFrame:
    """Binders at or under a percentile.

    Blank cells default: start to 0, end to what start and the peptide's length say, seq_num to 1, score to the
    percentile. ids (seq_num, sequence_id) names the sequences; one that it does not name has an empty id.
    """
    check_binding_header(spark, path)
    rows, names = _table(spark, path)
    if not names or rows.isEmpty():
        return spark.createDataFrame([], _BINDING)
    find = lambda candidates, what, required=True: files.resolve_column(names, candidates, what, required)
    allele, peptide, percentile = find(ALLELE, "allele"), find(PEPTIDE, "peptide"), find(PERCENTILE, "percentile rank")

    def given(candidates: list[str], what: str, default: Column) -> Column:
        name = find(candidates, what, False)
        return default if name is None else F.when(F.coalesce(F.col(f"`{name}`"), F.lit("")) == "", default).otherwise(files.to_float(_text(name), what))

    out = rows.select(_text(allele).alias("allele"), F.upper(_text(peptide)).alias("peptide"), files.to_float(_text(percentile), "percentile rank").alias("percentile"), given(START, "start", F.lit(0.0)).cast("int").alias("start"), given(END, "end", F.lit(None)).cast("int").alias("end"), given(SEQUENCE_NUMBER, "sequence number", F.lit(1.0)).cast("int").alias("seq_num"), given(BINDING_SCORE, "score", F.lit(None)).cast("double").alias("score"))
    out = out.where((F.col("percentile") <= cutoff) & (F.col("peptide") != ""))
    last = F.when(F.col("start") != 0, F.col("start") + F.length("peptide") - 1).otherwise(0)
    out = out.withColumn("end", F.coalesce("end", last)).withColumn("score", F.coalesce("score", "percentile"))
    out = out.withColumn("sequence_id", F.lit("")) if ids is None else out.join(ids.select(F.col("seq_num").cast("int").alias("seq_num"), "sequence_id"), "seq_num", "left").withColumn("sequence_id", F.coalesce("sequence_id", F.lit("")))
    return out.select("allele", "peptide", "start", "end", "seq_num", "sequence_id", "percentile", "score")


def scan_immunogenicity(spark: SparkSession, path: str, asked: DataFrame) -> DataFrame:
    """(peptide, score) behind a preamble; every peptide asked for, in upper case, must have one."""
    rows, names = _table(spark, path, "peptide")
    if not names or rows.isEmpty():
        raise ValueError(f"no scores in {path}")
    peptide, score = files.resolve_column(names, PEPTIDE, "peptide"), files.resolve_column(names, IMMUNOGENICITY, "score")
    found = rows.select("__file", "__row", F.upper(_text(peptide)).alias("peptide"), files.to_float(_text(score), "immunogenicity").alias("score")).where("peptide <> ''")
    found = files.last_rows(found, "peptide")
    files.must_cover(asked.select(F.upper(F.trim("peptide")).alias("peptide")).where("peptide <> ''").distinct(), found, "peptide")
    return found


def scan_antigenicity(spark: SparkSession, path: str) -> DataFrame:
    """(sequence_id, score): null where the tool said in words that it did not score; a category is no score."""
    return files.scan_scores(spark, path, ANTIGENICITY_ID, ANTIGENICITY_SCORE, ANTIGENICITY_UNSCORED)


def scan_allergenicity(spark: SparkSession, path: str, asked: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(sequence_id, score, allergen) of every sequence_id asked for: the tool's own verdict where it gives one, else the score's."""
    rows, names = _table(spark, path)
    if not names or rows.isEmpty():
        raise ValueError(f"no rows in {path}")
    name, value = files.resolve_column(names, ALLERGENICITY_ID, "id"), files.resolve_column(names, ALLERGENICITY_SCORE, "score")
    said = files.resolve_column(names, ALLERGENICITY_CALL, "call", required=False)
    call = F.lower(F.coalesce(F.col(f"`{said}`"), F.lit(""))) if said else F.lit("")
    score = files.to_float(_text(value), "allergenicity")
    verdict = F.when(call != "", F.contains(call, F.lit("allergen")) & ~F.contains(call, F.lit("non"))).otherwise(score >= threshold)
    found = rows.select("__file", "__row", files.first_token(F.col(f"`{name}`")).alias("sequence_id"), score.alias("score"), verdict.alias("allergen"))
    found = files.last_rows(found, "sequence_id")
    files.must_cover(asked.select("sequence_id").distinct(), found, "sequence_id")
    return found


def scan_bepipred(spark: SparkSession, path: str) -> DataFrame:
    """(sequence_id, position, score): a row a residue in file order, the raw score and not its rolling mean."""
    return files.scan_wide_residues(spark, path, BEPIPRED_ID, BEPIPRED_SCORE, tuple(BEPIPRED_POSITION))


def scan_epidope(spark: SparkSession, path: str) -> DataFrame:
    """(sequence_id, position, score) of a sectioned table, or of a flat one where no line opens a section."""
    if files.numbered_lines(spark, path).where("ltrim(line) like '>%'").isEmpty():
        return files.scan_wide_residues(spark, path, EPIDOPE_ID, EPIDOPE_SCORE, tuple(EPIDOPE_POSITION))
    by = Window.partitionBy("sequence_id").orderBy("position")
    return files.scan_sections(spark, path).select("sequence_id", F.row_number().over(by).cast("long").alias("position"), "score")


def scan_cluster_csv(spark: SparkSession, path: str) -> DataFrame:
    """(file, cluster_ord, cluster_id, consensus, member_ord, member_index, alignment, position, description, sequence).

    A consensus row opens a cluster, and so does a member of another cluster than the row before: its peptide is its
    own consensus. A cluster without members has one row with nulls for it.
    """
    lines = files.numbered_lines(spark, path).where(F.length("line") > 0)
    tabs = lines.groupBy("file").agg(F.sum(F.length("line") - F.length(F.replace("line", F.lit("\t"), F.lit("")))).alias("tabs"), F.sum(F.length("line") - F.length(F.replace("line", F.lit(","), F.lit("")))).alias("commas"))
    schema = ", ".join(f"c{i} string" for i in range(6))
    parsed = lambda sep: F.from_csv("line", F.lit(schema), {"sep": sep, "escape": '"'})
    rows = lines.join(F.broadcast(tabs), "file").select("file", "n", F.when(F.col("tabs") > F.col("commas"), parsed("\t")).otherwise(parsed(",")).alias("r"))
    cell = lambda i: F.trim(F.coalesce(f"r.c{i}", F.lit(""))).alias(f"c{i}")
    rows = rows.where("r.c2 is not null").select("file", "n", *(cell(i) for i in range(6)), F.col("r.c5").isNotNull().alias("full"))
    rows = rows.where(~(F.startswith(F.lower("c0"), F.lit("cluster")) & F.contains(F.lower("c1"), F.lit("number"))))
    is_consensus = F.lower("c1").isin(*CONSENSUS_MARKERS)
    block, at = F.col("n.block"), F.col("n")
    rows = carried_forward(rows, ["file"], block, at, {"former": F.col("c0")}, before=True)
    opens = is_consensus | F.coalesce(F.col("c0") != F.col("former"), F.lit(True))
    rows = running_sum(rows.withColumn("is_consensus", is_consensus).withColumn("opens", opens), ["file"], block, at, F.col("opens").cast("long"), "cluster_ord")
    said = F.when(F.col("is_consensus"), F.col("c2")).when(F.col("opens"), F.when(F.col("full"), F.col("c5")).otherwise(F.col("c2")))
    heads = rows.where("opens").select("file", "cluster_ord", F.col("c0").alias("cluster_id"), said.alias("consensus"))
    within = Window.partitionBy("file", "cluster_ord").orderBy("n")
    members = rows.where("not is_consensus").select("file", "cluster_ord", F.row_number().over(within).alias("member_ord"), F.col("c1").alias("member_index"), F.col("c2").alias("alignment"), F.col("c3").alias("position"), F.col("c4").alias("description"), F.col("c5").alias("sequence"))
    return heads.join(members, ["file", "cluster_ord"], "left")


def sink_clusters_csv(members: DataFrame, path: str) -> None:
    """members (cluster_ord, cluster_id, consensus, member_index, alignment, position, description, sequence): of each cluster its consensus, then its members."""
    cells = [F.col("cluster_id"), F.col("member_index").cast("string"), F.col("alignment"), F.col("position").cast("string"), F.col("description"), F.col("sequence")]
    row = lambda own: [c.alias(n) for c, n in zip(own, CLUSTER_HEADER, strict=True)]
    dash = F.lit("-")
    order = F.coalesce(F.col("member_index").try_cast("long"), F.lit(0)).alias("at")
    heads = members.select("cluster_ord", "cluster_id", "consensus").distinct().select("cluster_ord", F.lit(-1).cast("long").alias("at"), *row([F.col("cluster_id"), F.lit("Consensus"), F.col("consensus"), dash, dash, dash]))
    rows = heads.unionByName(members.where("member_index is not null").select("cluster_ord", order, *row(cells)))
    line = F.to_csv(F.struct(*(f"`{n}`" for n in CLUSTER_HEADER)), {"quote": '"', "escape": '"', "nullValue": "", "emptyValue": ""})
    files.as_one_file(rows.select("cluster_ord", "at", line.alias("value")), ["cluster_ord", "at"], path, [",".join(CLUSTER_HEADER)])


def sink_iedb_upload(targets: DataFrame, epitopes: DataFrame, folder: str) -> None:
    """targets (strain, accession, sequence) as one FASTA by strain, and epitopes (sequence) one a line, for a web tool's forms."""
    files.sink_fasta(targets.orderBy("strain", "accession").select(F.concat("strain", F.lit("|"), "accession").alias("header"), "sequence"), f"{folder}/targets")
    epitopes.select("sequence").write.text(f"{folder}/epitopes")


def md_cell(x: Column) -> Column:
    """A value for a cell of a Markdown table, where a bare bar would begin a new cell."""
    return F.replace(F.coalesce(x.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))


def markdown_line(cells: list[Column]) -> Column:
    """A row of a Markdown table."""
    return F.concat(F.lit("| "), F.concat_ws(" | ", *(md_cell(c) for c in cells)), F.lit(" |"))


def markdown_rows(df: DataFrame) -> DataFrame:
    """The rows of a Markdown table (line), in the order of df."""
    return df.select(markdown_line([F.col(f"`{c}`") for c in df.columns]).alias("line"))


def markdown_head(df: DataFrame) -> list[str]:
    """The two lines above the rows of a Markdown table."""
    numbers = ("int", "bigint", "double", "float", "smallint", "tinyint")
    rule = [" ---: " if kind in numbers else " --- " for _, kind in df.dtypes]
    names = " | ".join(c.replace("|", "\\|") for c in df.columns)
    return [f"| {names} |", f"|{'|'.join(rule)}|"]


def markdown_table(df: DataFrame) -> list[str]:
    """A small table's lines: it is collected."""
    return [*markdown_head(df), *(r.line for r in markdown_rows(files.as_text(df)).collect())]


def sink_markdown(spark: SparkSession, path: str, title: str, lines: list[str]) -> None:
    """A summary for people: one small file. Blanks at the end of a line stay, as they mean a line break."""
    text = "\n".join([f"# {title}", "", *(x.rstrip("\r\n") for x in lines)])
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)


def sink_markdown_table(df: DataFrame, order: list[str], path: str, title: str) -> None:
    """A table of any size below a title, in order: its lines are written by many tasks and put together as one file."""
    keys = [f"__{i}" for i in range(len(order))]
    text = df.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(order, keys, strict=True)), *(files.text_of(n, kind) for n, kind in df.dtypes))
    files.as_one_file(text.select(*keys, markdown_line([F.col(f"`{c}`") for c in df.columns]).alias("value")), keys, path, [f"# {title}", "", *markdown_head(df)])


def sink_provenance(rows: DataFrame, path: str) -> None:
    """One JSON object a row: what was asked of a source and what came of it. Nulls are written."""
    rows.write.json(path, ignoreNullFields=False)


def sink_passing_fasta(screened: DataFrame, path: str) -> None:
    """screened (consensus_id, sequence, passes): what passed the screens as one file, in order of its ids, a line a sequence."""
    files.sink_fasta_file(screened.where("passes").select("consensus_id", F.col("consensus_id").cast("string").alias("header"), "sequence"), ["consensus_id"], path, width=0)


def final_fasta(final: DataFrame, path: str) -> None:
    """final (rank, consensus_id, sequence) as one file in the order of rank, a line a sequence."""
    files.sink_fasta_file(final.select("rank", F.col("consensus_id").alias("header"), "sequence"), ["rank"], path, width=0)


def final_report(spark: SparkSession, final: DataFrame, attrition: DataFrame, path: str, set_coverage: DataFrame | None = None) -> None:
    """The run's summary as one file: how many candidates, which of them are called allergens, what each stage left, and the ranked list.

    final (rank, consensus_id, protein_label, sequence, length, antigenicity_score, conservancy_percent,
    conservancy_per_strain, world_coverage_percent, allergen); attrition begins with the protein, a row for each. Rows
    of tables are written where they are; the driver has the counts and headings alone.
    """
    n, flagged = final.agg(F.count("*"), F.count_if("allergen")).first()
    rows: list[DataFrame] = []

    def say(*lines: str) -> None:
        rows.append(spark.createDataFrame([(len(rows), i, x) for i, x in enumerate(lines)], "section int, at long, value string"))

    def put(lines: DataFrame) -> None:
        rows.append(lines.select(F.lit(len(rows)).alias("section"), F.col("at").cast("long").alias("at"), F.col("line").alias("value")))

    say("# Candidate run", "", f"Candidates left after all stages: **{n}**.", "")
    if flagged:
        say(f"Called allergens, which is advisory: **{flagged}**.", "")
        put(final.where("allergen").select(F.col("rank").alias("at"), F.concat(F.lit("- `"), "consensus_id", F.lit("`")).alias("line")))
        say("")
    say("## What each stage left", "", *markdown_head(attrition))
    text = files.as_text(attrition)
    ordered = numbered(text, [], [F.asc(text.columns[0])], "__at")
    put(ordered.select(F.col("__at").alias("at"), markdown_line([F.col(f"`{c}`") for c in text.columns]).alias("line")))
    say("", "## Ranked list", "")
    if n:
        shown = final.select("rank", "consensus_id", "protein_label", "sequence", "length", "antigenicity_score", "conservancy_percent", "conservancy_per_strain", "world_coverage_percent")
        percent = lambda c: F.coalesce(F.concat(fs.number_text(F.col(c).cast("double")), F.lit("%")), F.lit("-"))
        cells = {c: F.col(c) for c in shown.columns} | {c: percent(c) for c in ("conservancy_percent", "world_coverage_percent")}
        cells |= {"antigenicity_score": fs.number_text(F.col("antigenicity_score").cast("double")), "conservancy_per_strain": F.coalesce("conservancy_per_strain", F.lit("-"))}
        say(*markdown_head(shown))
        put(shown.select(F.col("rank").alias("at"), markdown_line(list(cells.values())).alias("line")))
        if set_coverage is not None:
            say("", "Coverage of all candidates of a protein together:", "")
            said = files.as_text(set_coverage.select("protein_label", "coverage"))
            put(numbered(said, [], [F.asc("protein_label")], "at").select("at", F.concat(F.lit("- **"), "protein_label", F.lit("**: "), "coverage", F.lit("%")).alias("line")))
    else:
        say("No candidate is left. The attrition above shows the stage that emptied the list.")
    files.as_one_file(reduce(DataFrame.union, rows), ["section", "at"], path)
