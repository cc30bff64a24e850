"""Parsing, formatting and scoring of single values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievemark.functions import sequences as fs
from sievemark.operators import records
from sievemark.plans.catalog import query, table
from sievemark.sources.files import to_float as to_number

_HEADERS = "headers as (select doc_id, concat(doc_id, ' ', source, ' [', lang, ']') as header from documents)"


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(" "), "source", F.lit(" ["), "lang", F.lit("]")).alias("header"))


@query("parse_defline", f"with {_HEADERS} select doc_id, regexp_extract(header, '{fs.DEFLINE}', 1) as accession, regexp_extract(header, '{fs.DEFLINE}', 2) as name, regexp_extract(header, '{fs.DEFLINE}', 3) as strain from headers")
def parse_defline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers(spark, sf_dir).select("doc_id", *fs.defline(F.col("header")))


@query("record_id", f"with {_HEADERS} select doc_id, regexp_extract(header, '^\\S*') as record_id from headers")
def record_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers(spark, sf_dir).select("doc_id", fs.record_id(F.col("header")).alias("record_id"))


@query("filename_fallback", "select p_partkey, coalesce(nullif(case when p_size % 2 = 0 then p_name else '' end, ''), nullif(regexp_extract(concat(p_partkey, ' ', p_type, ' - ', p_brand), '^(\\S+)\\s+(.+?)\\s+-\\s+(.+)$', 2), ''), 'unknown protein') as name from part")
def filename_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    stem = F.concat(F.col("p_partkey").cast("string"), F.lit(" "), "p_type", F.lit(" - "), "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", fs.fallback(F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(""), stem, 2, "unknown protein").alias("name"))


#: a-z as A-Z in SQL, as fs.folded does it.
def folded_sql(x: str) -> str:
    return f"translate({x}, '{fs._LOWER}', '{fs._UPPER}')"


@query("seq_md5", f"select doc_id, md5({folded_sql('text')}) as md5 from documents")
def seq_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(fs.folded(F.col("text"))).alias("md5"))


@query("seq_md5_all")
def seq_md5_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With every letter in upper case, also beyond A-Z; without SQL, as upper() differs there."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.upper("text")).alias("md5"))


_ALIASES = [("promo", "Promo"), ("brand#1", "FirstBrand"), ("brand#12", "TwelfthBrand"), ("brand#2", "SecondBrand")]


@query("normalise_label", "with a(alias, label, ord) as (values " + ", ".join(f"('{a}', '{b}', {i})" for i, (a, b) in enumerate(_ALIASES)) + """), m as (select p_partkey, arg_max(label, length(alias) * 1000 - ord) as label from part join a on contains(lower(p_brand), alias) group by p_partkey)
 select p_partkey, coalesce(label, regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) as label from part left join m using (p_partkey)""")
def normalise_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    aliases = F.broadcast(spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(_ALIASES)], "alias string, label string, ord int"))  # a fixed handful
    met = part.join(aliases, F.contains(F.lower("p_brand"), F.col("alias"))).groupBy("p_partkey").agg(F.max_by("label", F.length("alias") * 1000 - F.col("ord")).alias("label"))
    words = F.array_join(F.transform(F.split(F.regexp_replace("p_brand", "[^A-Za-z0-9]+", " "), " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), "")
    return part.join(met, "p_partkey", "left").select("p_partkey", F.coalesce("label", F.nullif(words, F.lit("")), F.lit("Unknown")).alias("label"))


@query("make_header", "select p_partkey, concat(regexp_replace(trim(p_type), '\\s+', '_', 'g'), '|', regexp_replace(trim(p_name), '\\s+', '_', 'g'), '|', p_partkey) as header from part")
def make_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", fs.header_of(F.col("p_type"), F.col("p_name"), F.col("p_partkey").cast("string")).alias("header"))


@query("parse_header", "select p_partkey, split_part(h, '|', 1) as protein, split_part(h, '|', 2) as strain, split_part(h, '|', 3) as accession from (select p_partkey, case p_size % 3 when 0 then concat(p_brand, '|', p_name, '|', p_partkey) when 1 then concat(p_brand, '|', p_name) else p_brand end as h from part)")
def parse_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = F.concat_ws("|", "p_brand", "p_name", F.col("p_partkey").cast("string"))
    header = F.when(F.col("p_size") % 3 == 0, full).when(F.col("p_size") % 3 == 1, F.concat_ws("|", "p_brand", "p_name")).otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", *fs.header_parts(header))


@query("slug", "select p_partkey, coalesce(nullif(trim(regexp_replace(trim(concat(p_brand, ' / ', p_type)), '[^A-Za-z0-9]+', '_', 'g'), '_'), ''), 'unknown') as slug from part")
def slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", fs.slug(F.concat("p_brand", F.lit(" / "), "p_type")).alias("slug"))


@query("parse_epitope_id", "with i as (select o_orderkey, case when o_orderkey % 5 = 0 then 'junk' else concat('Spike_', case o_orderkey % 2 when 0 then 'B_cell' else 'T_cell' end, '_Tool', o_custkey % 3, '_', o_custkey, '.', o_orderkey % 7) end as id from orders) select o_orderkey, nullif(regexp_extract(id, '^(.+)_(B_cell|T_cell)_([A-Za-z0-9-]+)_(\\d+)\\.(\\d+)$', 1), '') as protein, nullif(regexp_extract(id, '^(.+)_(B_cell|T_cell)_([A-Za-z0-9-]+)_(\\d+)\\.(\\d+)$', 3), '') as tool from i")
def parse_epitope_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.format_string("Spike_%s_Tool%d_%d.%d", F.when(F.col("o_orderkey") % 2 == 0, "B_cell").otherwise("T_cell"), F.col("o_custkey") % 3, F.col("o_custkey"), F.col("o_orderkey") % 7)
    ids = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "junk").otherwise(made).alias("id"))
    return ids.select("o_orderkey", *(F.nullif(F.regexp_extract("id", fs.EPITOPE_ID, i), F.lit("")).alias(n) for i, n in ((1, "protein"), (3, "tool"))))


@query("windows", f"select item_id, unnest(case when length(text) < 50 then [{folded_sql('text')}] else list_transform(range(1, length(text) - 48), lambda i: substr({folded_sql('text')}, i, 50)) end) as window from benchmark where text <> ''")
def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", F.explode(fs.windows(F.col("text"), 50)).alias("window"))


@query("standard_residue_filter", "with w as (select p_partkey, unnest(list_transform(range(1, length(p_name) - 3), lambda i: substr(upper(p_name), i, 5))) as w from part where length(p_name) >= 5) select p_partkey, count(*) filter (regexp_matches(w, '^[ACDEFGHIKLMNPQRSTVWY]+$')) as n_screened, count(*) filter (not regexp_matches(w, '^[ACDEFGHIKLMNPQRSTVWY]+$')) as n_skipped from w group by 1")
def standard_residue_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = fs.windows(F.upper("p_name"), 5)
    return table(spark, sf_dir, "part").where(F.length("p_name") >= 5).select("p_partkey", F.size(F.filter(w, fs.standard_only)).cast("long").alias("n_screened"), F.size(F.filter(w, lambda x: ~fs.standard_only(x))).cast("long").alias("n_skipped"))


_MATCH = "list_sum(list_transform(range(1, length({q}) + 1), lambda i: cast(substr({q}, i, 1) = substr({t}, o + i, 1) as int)))"
_PLACED = "list_max(list_transform(range(0, length({t}) - length({q}) + 1), lambda o: " + _MATCH + "))"
_PID = "case when contains(l, s) then 99.9::double else cast(" + _PLACED.format(q="s", t="l") + " as double) * 100 / length(l) end"
# Peptides: twenty parts are a family of four forms, which begin at one of two places, lack the last letter, or differ in
# one or two. Five parts have a form, so there are a fifth as many sequences as parts.
_FORM = "substr(translate(md5(cast(p_partkey // 20 as varchar)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), cast(1 + (p_partkey % 4) // 2 as int), cast(12 + (p_partkey // 20) % 6 - p_partkey % 2 as int))"
_PEPTIDE = f"case when p_partkey % 4 < 2 then {_FORM} else concat(substr({_FORM}, 1, 4), 'W', substr({_FORM}, 6, 3), case when p_partkey % 4 = 2 then 'Y' else substr({_FORM}, 9, 1) end, substr({_FORM}, 10)) end"
_NAMES = f"peptides as (select part.*, {_PEPTIDE} as peptide from part), names as (select peptide as name, min(p_partkey) as ord from peptides group by peptide)"


def peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part with a peptide for each."""
    form = "substr(translate(md5(cast(cast(p_partkey div 20 as string) as binary)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS'), int(1 + (p_partkey % 4) div 2), int(12 + (p_partkey div 20) % 6 - p_partkey % 2))"
    return table(spark, sf_dir, "part").withColumn("__f", F.expr(form)).withColumn("peptide", F.expr("if(p_partkey % 4 < 2, __f, concat(substr(__f, 1, 4), 'W', substr(__f, 6, 3), if(p_partkey % 4 = 2, 'Y', substr(__f, 9, 1)), substr(__f, 10)))")).drop("__f")


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sequence, ord): the distinct peptides, each with its first part."""
    return peptides(spark, sf_dir).groupBy(F.col("peptide").alias("sequence")).agg(F.min("p_partkey").alias("ord"))


@query("percent_identity", "with names as (select p_name as name, min(p_partkey) as ord from part group by p_name) select a, b, " + _PID + " as identity from (select x.ord as a, y.ord as b, case when length(x.name) <= length(y.name) then x.name else y.name end as s, case when length(x.name) <= length(y.name) then y.name else x.name end as l from names x join names y on x.ord < y.ord)")
def percent_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all pairs of the few distinct names of parts."""
    n = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("sequence")).agg(F.min("p_partkey").alias("ord"))
    a, b = n.select(F.col("ord").alias("a"), F.col("sequence").alias("sa")), n.select(F.col("ord").alias("b"), F.col("sequence").alias("sb"))
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", fs.percent_identity("sa", "sb").alias("identity"))


@query("max_identity_matches", "select p_partkey, cast(" + _PLACED.format(q="q", t="t") + " as bigint) as matches from (select p_partkey, p_name as q, concat(lower(p_type), reverse(p_name)) as t from part)")
def max_identity_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("q"), F.concat(F.lower("p_type"), F.reverse("p_name")).alias("t"))
    return part.select("p_partkey", fs.max_identity_matches("q", "t").cast("long").alias("matches"))


@query("window_identity", "select p_partkey, case when contains(p_type, p_name) then 1::double when length(p_type) < length(p_name) then cast(list_sum(list_transform(range(1, length(p_type) + 1), lambda i: cast(substr(p_name, i, 1) = substr(p_type, i, 1) as int))) as double) / length(p_name) else cast(" + _PLACED.format(q="p_name", t="p_type") + " as double) / length(p_name) end as identity from part")
def window_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", fs.window_identity("p_name", "p_type").alias("identity"))


@query("best_offset", """with c as (select p_partkey, unnest(range(1 - length(p_name), length(p_type))) as o, p_name as q, p_type as t from part),
 s as (select p_partkey, o, least(length(t), o + length(q)) - greatest(0, o) as overlap, coalesce(list_sum(list_transform(range(greatest(0, o), least(length(t), o + length(q))), lambda p: cast(substr(t, p + 1, 1) = substr(q, p - o + 1, 1) as int))), 0) as score from c)
 select p_partkey, o as best_offset from s qualify row_number() over (partition by p_partkey order by score desc, overlap desc, abs(o), o) = 1""")
def best_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", fs.best_offset("p_name", "p_type").cast("long").alias("best_offset"))


@query("pad_alignment", "select p_partkey, rpad(concat(repeat('-', p_size % 4), p_name), 20, '-') as alignment, p_size % 4 + 1 as position from part")
def pad_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    lead = F.col("p_size") % 4
    return table(spark, sf_dir, "part").select("p_partkey", F.rpad(F.concat(F.repeat(F.lit("-"), lead), "p_name"), 20, "-").alias("alignment"), (lead + 1).alias("position"))


_PROP = "p(residue, milli) as (values " + ", ".join(f"('{k}', {round(v * 1000)})" for k, v in fs.PROPENSITY.items()) + ")"


@query("antigenicity_kolaskar", f"""with {_PROP}, r as (select sequence_id, i, milli, count(*) over (partition by sequence_id) as n, row_number() over (partition by sequence_id order by i) as k from (select p_partkey as sequence_id, unnest(range(1, length(p_name) + 1)) as i, upper(p_name) as s from part) join p on residue = substr(s, i, 1)),
 w as (select a.sequence_id, a.k, sum(b.milli) * 420 // count(*) as smooth, max(a.n) as n, max(case when b.k = a.k then b.milli end) as milli from r a join r b on a.sequence_id = b.sequence_id and b.k between a.k - 3 and a.k + 3 group by 1, 2)
 select p_partkey, coalesce(cast(total as double) / 420000 / n, 0) as score from part left join (select sequence_id, sum(case when n >= 7 then smooth else milli * 420 end) as total, max(n) as n from w group by 1) on sequence_id = p_partkey""")
def antigenicity_kolaskar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of centred 7-residue means; in whole thousandths times 420, which every window's size divides, so sums are exact."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.upper("p_name").alias("s"))
    r = part.select("p_partkey", F.posexplode(F.split("s", "")).alias("i", "residue")).select("p_partkey", "i", F.round(fs.propensity(F.col("residue")) * 1000).cast("long").alias("milli")).where("milli is not null")
    near, every = Window.partitionBy("p_partkey").orderBy("i").rowsBetween(-3, 3), Window.partitionBy("p_partkey")
    smooth = r.select("p_partkey", "milli", F.expr("1").alias("one"), F.count("*").over(every).alias("n"), (F.sum("milli").over(near) * 420).alias("sum"), F.count("*").over(near).alias("width"))
    total = smooth.groupBy("p_partkey").agg(F.sum(F.when(F.col("n") >= 7, F.expr("sum div width")).otherwise(F.col("milli") * 420)).alias("total"), F.max("n").alias("n"))
    return part.join(total, "p_partkey", "left").select("p_partkey", F.coalesce(F.col("total").cast("double") / 420000 / F.col("n"), F.lit(0.0)).alias("score"))


@query("normalise_allele", "select p_partkey, split_part(concat(p_brand, case when p_size % 2 = 0 then concat('/', p_type) else '' end), '/', 1) as allele from part")
def normalise_allele(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.substring_index(F.concat("p_brand", F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("/"), "p_type")).otherwise("")), "/", 1).alias("allele"))


@query("fmt", "select p_partkey, rtrim(rtrim(printf('%.6f', p_retailprice), '0'), '.') as said from part")
def fmt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", fs.number_text(F.col("p_retailprice")).alias("said"))


_CODES = "case o_orderkey % 6 when 0 then 'True' when 1 then ' yes ' when 2 then '1' when 3 then 'no' when 4 then '12.7' else '' end"


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.element_at(F.array(*map(F.lit, ("True", " yes ", "1", "no", "12.7", ""))), (F.col("o_orderkey") % 6 + 1).cast("int")).alias("x"))


@query("as_bool", f"select o_orderkey, lower(trim({_CODES})) in ('true', 't', 'yes', 'y', '1') as flag from orders")
def as_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(spark, sf_dir).select("o_orderkey", fs.as_bool(F.col("x")).alias("flag"))


@query("as_int", f"select o_orderkey, coalesce(cast(trunc(try_cast({_CODES} as double)) as int), 0) as number from orders")
def as_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(spark, sf_dir).select("o_orderkey", fs.as_int(F.col("x")).alias("number"))


@query("as_float", f"select o_orderkey, coalesce(try_cast(trim({_CODES}) as double), -1) as number from orders")
def as_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(spark, sf_dir).select("o_orderkey", fs.as_float(F.col("x"), -1.0).alias("number"))


@query("to_float", "select p_partkey, p_retailprice as number from part")
def to_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers written as text, blanks around them, and read back; text that is no number would be an error."""
    said = F.concat(F.lit("  "), F.col("p_retailprice").cast("string"), F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", to_number(said, "price").alias("number"))


@query("describe_match", "select l_orderkey, l_linenumber, concat(l_returnflag, '@', l_partkey, ':', l_linenumber + 1) as said from lineitem")
def describe_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", fs.match_text(F.col("l_returnflag"), F.col("l_partkey").cast("string"), F.col("l_linenumber")).alias("said"))


# Ranges of thresholds, from the sizes of parts.
_SPEC = "case p_partkey % 6 when 0 then concat(p_size + 50, ':', p_size) when 1 then concat(p_size) when 2 then concat(p_size, ':', p_size + 1) when 3 then concat('0.', p_size) when 4 then concat(p_size + 60, ':50') else concat(p_size, ':x') end"


@query("threshold_scale_guard", f"with s as (select p_partkey, p_size, {_SPEC} as spec from part) select p_partkey, spec, case p_partkey % 6 when 0 then p_size > 1 and p_size <= 50 when 1 then p_size > 1 when 4 then p_size <= 40 else false end as accepted from s")
def threshold_scale_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which ranges of thresholds are accepted: per cent, over 1, from the higher to the lower."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.expr(_SPEC).alias("spec"))
    return part.select("p_partkey", "spec", fs.is_threshold_range(F.col("spec")).alias("accepted"))


@query("allele_length_grid", "select n_name as allele, length from nation, (values (8), (9), (10)) t(length)")
def allele_length_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.allele_length_grid(table(spark, sf_dir, "nation").select(F.col("n_name").alias("allele")), [8, 9, 10])


@query("threshold_sweep", "with p as (select p_partkey, 50 + p_size % 50 as high, 2 + p_size % 40 as low from part) select p_partkey, unnest(list_distinct(list_concat(range(high, low, -10), [low]))) as threshold from p")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thresholds of a range for each part, the last one always among them."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.expr("concat(50 + p_size % 50, ':', 2 + p_size % 40)").alias("spec"))
    return part.select("p_partkey", F.explode(fs.thresholds_of(F.col("spec")).cast("array<bigint>")).alias("threshold"))
