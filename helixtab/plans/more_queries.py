"""Queries over functions and orders that the other modules' queries leave out, on the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixtab.functions import scalars as X
from helixtab.operators import copynumber as N
from helixtab.operators import filters as P
from helixtab.operators import joins as J
from helixtab.operators import tables as T
from helixtab.operators import windows as W
from helixtab.plans import copynumber, quality
from helixtab.plans.queries import LINE, ORACLE_SQL, query


def _text(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


@query("""SELECT c_custkey, lower(regexp_replace(c_name, '[^0-9a-zA-Z]+', '_', 'g')) AS name, CASE c_custkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Male' END AS sex,
CASE WHEN c_nationkey = 23 THEN 'X' WHEN c_nationkey = 24 THEN 'Y' ELSE '' || c_nationkey END AS chrom, 'chr' || c_nationkey AS with_chr FROM customer""")
def clean_labels(t):
    k = F.col("c_custkey") % 4
    sex = F.when(k == 0, " M ").when(k == 1, "female").when(k == 2, "Male").otherwise("?")
    chrom = X.number_to_sex(_text("c_nationkey"))
    return t.customer.select("c_custkey", X.clean_name(F.col("c_name")).alias("name"), X.sex(sex).alias("sex"), chrom.alias("chrom"), X.with_chr(X.sex_to_number(X.without_chr(F.concat(F.lit("chr"), chrom)))).alias("with_chr"))


@query("SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN 0 ELSE 1 END AS first, CASE p_partkey % 3 WHEN 0 THEN 0 ELSE 1 END AS second FROM part")
def junction_strands(t):
    side = lambda m: F.when(F.col("p_partkey") % m == 0, "3").otherwise("5")
    return t.part.select("p_partkey", X.strands(F.concat_ws("to", side(2), side(3))).alias("s")).select("p_partkey", "s.*")


@query("SELECT p_partkey, 'g' || p_size AS gene, 'tx' || p_partkey AS transcript, 'e1' AS exon FROM part UNION ALL SELECT p_partkey, 'g' || p_size + 1, 't2', 'e2' FROM part")
def gene_label_parts(t):
    label = F.concat(F.lit("g"), _text("p_size"), F.lit(":tx"), _text("p_partkey"), F.lit(":e1:b,g"), _text(F.col("p_size") + 1), F.lit(":t2:e2:b"))
    return t.part.select("p_partkey", F.explode(X.gene_labels(label)).alias("l")).select("p_partkey", "l.gene", "l.transcript", "l.exon")


@query("""SELECT p_partkey, p_partkey % 3 <> 0 AS same_chromosome, p_partkey % 3 <> 0 AND (p_partkey % 2 = 0 OR p_size % 5 <= 1) AS same_band,
least(100, greatest(1, p_size - 10)) AS clamped, p_size < p_size % 9 + 20 AND p_size % 9 < p_size + 15 AS overlap FROM part""")
def band_similarity(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    a = F.when(k % 3 == 0, "8q10").otherwise(F.when(k % 2 == 0, "7q10").otherwise("7q10.1"))
    b = F.when(k % 2 == 0, F.lit("7qter")).otherwise(F.concat(F.lit("7q"), _text(10 + s % 5)))
    return t.part.select("p_partkey", X.same_chromosome(a, b).alias("same_chromosome"), X.same_major_band(a, b).alias("same_band"), X.clamped(s, -10, F.lit(100)).alias("clamped"), X.overlaps_strictly(s, s + 10, s % 9, s % 9 + 15, 5).alias("overlap"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, printf('%.2f', l_quantity / 4) AS text FROM lineitem WHERE l_quantity::INT % 2 = 0")
def two_decimal_text(t):
    return t.lineitem.where(F.col("l_quantity").cast("int") % 2 == 0).select(*LINE, X.two_decimals(F.col("l_quantity") / 4).alias("text"))


@query("SELECT c_custkey, c_nationkey % 3 AS number, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_custkey END AS value FROM customer")
def leading_numbers(t):
    return t.customer.select("c_custkey", X.leading_int(F.concat(F.lit("  "), _text(F.col("c_nationkey") % 3), F.lit("x"))).cast("int").alias("number"), X.as_int(F.when(F.col("c_custkey") % 2 == 0, "NA").otherwise(_text("c_custkey"))).alias("value"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE > DATE '1997-01-01'")
def newer_rows(t):
    from helixtab.sources.tables import newer

    return newer(t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")), "day", "1997-01-01").select("o_orderkey")


# ---------------------------------------------------------------- orders: the first rows of a report, which is the feature


@query("SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 40")
def sorted_by_text(t):
    return T.distinct_sorted(t.part.select("p_name", "p_partkey"), "p_name", "p_partkey").limit(40).select("p_partkey", "p_name")


@query("SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 40")
def sorted_by_change(t):
    return t.part.orderBy(F.desc("p_retailprice"), "p_partkey").limit(40).select("p_partkey")


@query("SELECT p_partkey, 'x' || p_brand AS probe FROM part ORDER BY p_partkey % 2, p_size, p_partkey LIMIT 60")
def genes_before_tiling(t):
    return t.part.select("p_partkey", F.concat(F.lit("x"), "p_brand").alias("probe"), (F.col("p_partkey") % 2).alias("tiling"), "p_size").orderBy("tiling", "p_size", "p_partkey").limit(60).select("p_partkey", "probe")


@query("SELECT p_partkey, p_size AS position FROM (SELECT p_partkey, p_size FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, p_size FROM part WHERE p_partkey % 2 = 1) ORDER BY p_size, p_partkey LIMIT 60")
def merged_in_order(t):
    """Two sorted tables as one."""
    of = lambda r: t.part.where(F.col("p_partkey") % 2 == r).select("p_partkey", F.col("p_size").alias("position"))
    return T.union_checked(of(0), of(1)).orderBy("position", "p_partkey").limit(60)


@query("SELECT s_suppkey, rank() OVER (ORDER BY bad / n::DOUBLE DESC, s_suppkey) AS place FROM (SELECT l_suppkey AS s_suppkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS bad FROM lineitem GROUP BY 1)")
def worst_first(t):
    """Samples from worst to best by a derived ratio."""
    each = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg((F.count_if(F.col("l_returnflag") == "R") / F.count("*")).alias("share"))
    return W.numbered(each, [], [F.desc("share"), F.col("s_suppkey")], F.lit(""), "place").select("s_suppkey", F.regexp_extract("place", r"(\d+)", 1).cast("long").alias("place"))


@query("SELECT k, row_number() OVER (ORDER BY first) AS nth FROM (SELECT o_orderpriority AS k, min(o_orderkey) AS first FROM orders GROUP BY 1)")
def first_seen_order(t):
    """Names in the order in which they are first seen."""
    first = t.orders.groupBy(F.col("o_orderpriority").alias("k")).agg(F.min("o_orderkey").alias("first"))
    return W.barcodes(first, [F.col("first")], form="%d", name="nth").select("k", F.col("nth").cast("long").alias("nth"))


# ---------------------------------------------------------------- copy number, samples


@query("""
WITH r AS (SELECT event_id, user_id % 50 AS target, event_type AS batch, value AS lr, CASE WHEN user_id % 5 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'M' ELSE 'F' END ELSE 'any' END AS sex FROM events WHERE value IS NOT NULL),
o AS (SELECT target, sex, batch, median(lr) AS m, count(*) AS n FROM r GROUP BY ALL), a AS (SELECT target, sex, median(lr) AS m FROM r GROUP BY ALL)
SELECT event_id, round(lr + CASE WHEN n >= 3 THEN a.m - o.m ELSE 0 END, 6) AS lr FROM r JOIN o USING (target, sex, batch) JOIN a USING (target, sex)""")
def sex_batch_medians(t):
    """Batch correction in which some targets compare samples of one sex only."""
    rows = t.events.where("value is not null").select("event_id", (F.col("user_id") % 50).alias("target"), F.col("event_type").alias("batch"), F.col("value").alias("lr"), F.when(F.col("event_id") % 2 == 0, "M").otherwise("F").alias("sex"), (F.col("user_id") % 5 == 0).alias("on_x"))
    return N.batch_adjusted(rows, sexes="sex", sex_targets="on_x").select("event_id", F.round("lr", 6).alias("lr"))


@query("""SELECT p_size AS gene, coalesce('' || max(p_partkey) FILTER (p_brand = 'Brand#11'), 'NA') AS "Brand#11", coalesce('' || max(p_partkey) FILTER (p_brand = 'Brand#12'), 'NA') AS "Brand#12" FROM part GROUP BY 1""")
def call_matrix(t):
    calls = t.part.groupBy(F.col("p_size").alias("gene"), F.col("p_brand").alias("sample")).agg(F.max("p_partkey").alias("call"))
    return copynumber.call_matrix(calls, ["Brand#11", "Brand#12"])


@query("SELECT c_nationkey AS gene, count(DISTINCT c_custkey) AS n_exons, round(avg(c_acctbal), 6) AS mean FROM (SELECT c_custkey, c_acctbal, unnest([c_nationkey, c_nationkey + 1]) AS c_nationkey FROM customer) GROUP BY 1")
def gene_means(t):
    """Means of genes over the segments of their probes; a probe may have several genes."""
    label = F.concat(F.lit(""), _text("c_nationkey"), F.lit(":t:e:b,"), _text(F.col("c_nationkey") + 1), F.lit(":t:e:b"))
    each = t.customer.select("c_custkey", "c_acctbal", F.explode(X.gene_labels(label)).alias("l"))
    return each.groupBy(F.col("l.gene").cast("int").alias("gene")).agg(F.count_distinct("c_custkey").alias("n_exons"), F.round(F.avg("c_acctbal"), 6).alias("mean"))


@query("SELECT p_partkey, 'rs' || s_suppkey AS rsid FROM part LEFT JOIN supplier ON p_partkey * 3 = s_suppkey")
def probe_names(t):
    """Probes with the names of known sites at their place, if any."""
    sites = t.supplier.select(F.col("s_suppkey").alias("place"), F.concat(F.lit("rs"), _text("s_suppkey")).alias("rsid"))
    return J.annotate(t.part.select("p_partkey", (F.col("p_partkey") * 3).alias("place")), sites, ["place"]).select("p_partkey", "rsid")


@query("SELECT l_partkey AS target, sum(l_quantity) AS cov FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25) GROUP BY 1")
def common_targets(t):
    """Coverage of the targets that a standard has too."""
    own = t.lineitem.groupBy(F.col("l_partkey").alias("target")).agg(F.sum("l_quantity").alias("cov"))
    standard = t.part.where("p_size > 25").select(F.col("p_partkey").alias("target"))
    return own.join(T.common_keys(own, standard, ["target"]), "target")


@query("SELECT p_size AS start, max(p_name) FILTER (p_partkey % 2 = 0) AS tumor, max(p_name) FILTER (p_partkey % 2 = 1) AS normal FROM part GROUP BY 1")
def pair_lists(t):
    """A row for each interval with both samples of a pair beside each other."""
    kind = F.when(F.col("p_partkey") % 2 == 0, "tumor").otherwise("normal")
    return T.pivot(t.part.select(F.col("p_size").alias("start"), kind.alias("kind"), "p_name"), ["start"], "kind", ["tumor", "normal"], F.max("p_name"))


@query("SELECT c_custkey AS sample, c_acctbal AS peak FROM customer WHERE abs(c_acctbal - (SELECT avg(c_acctbal) FROM customer)) > 1.5 * (SELECT stddev_samp(c_acctbal) FROM customer)")
def insert_peak_alerts(t):
    return quality.peak_alerts(t.customer.select(F.col("c_custkey").alias("sample"), F.col("c_acctbal").alias("peak")), 1.5).select("sample", "peak")


@query("SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0")
def indel_class(t):
    k = F.col("p_partkey") % 3
    return P.indels(t.part.select("p_partkey", F.when(k == 0, "SNP").when(k == 1, "INS").otherwise("DEL").alias("Variant_Type"))).select("p_partkey")


@query("SELECT count(*) = 0 AS empty, 'none' AS name FROM part WHERE p_size < 0 UNION ALL SELECT count(*) = 0, 'some' FROM part")
def emptiness(t):
    """Whether tables have rows, looked at one row each."""
    of = lambda df, name: df.limit(1).agg((F.count("*") == 0).alias("empty")).select("empty", F.lit(name).alias("name"))
    return of(t.part.where("p_size < 0"), "none").unionAll(of(t.part, "some"))


@query("SELECT p_partkey, row_number() OVER (ORDER BY -p_retailprice, p_partkey) AS place FROM part")
def places_by_change(t):
    """The place of every row, largest change first."""
    return T.positioned(t.part.select("p_partkey", (-F.col("p_retailprice")).alias("_change")), ["_change", "p_partkey"]).select("p_partkey", "place")


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_partkey % 2, p_size, p_partkey) AS place FROM part")
def places_tiling_last(t):
    """The place of every row: genes by position, then tiling probes."""
    return T.positioned(t.part.select("p_partkey", (F.col("p_partkey") % 2).alias("_tiling"), "p_size"), ["_tiling", "p_size", "p_partkey"]).select("p_partkey", "place")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(p_brand, 'none') AS impact, coalesce(p_size, 0) AS score FROM lineitem LEFT JOIN (SELECT p_partkey, p_brand, p_size FROM part WHERE p_partkey % 3 <> 0) ON p_partkey = l_partkey")
def impact_lookup(t):
    """Predicted impact from a cached table; what the table lacks has a value of its own."""
    known = t.part.where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("impact"), F.col("p_size").alias("score"))
    return J.annotate(t.lineitem.select(*LINE), known, ["l_partkey"], fill={"impact": "none", "score": 0}).select(*LINE, "impact", "score")


@query("""
WITH e AS (SELECT p_partkey, p_partkey::BIGINT AS pos, substr('ACGTA', 1, p_size % 3 + 1) AS ref, substr('ACTTG', 1, p_partkey % 4 + 1) AS alt, CASE p_size % 2 WHEN 0 THEN '0/1' ELSE '1/1' END AS gt FROM part),
f AS (SELECT *, len(ref) > len(alt) AS del, len(ref) < len(alt) AS ins FROM e),
g AS (SELECT *, CASE WHEN del OR ins THEN CASE WHEN len(ref) > 1 THEN substr(ref, 2) ELSE '-' END ELSE ref END AS r, CASE WHEN del OR ins THEN CASE WHEN len(alt) > 1 THEN substr(alt, 2) ELSE '-' END ELSE alt END AS a FROM f)
SELECT p_partkey, CASE WHEN del THEN pos + 1 ELSE pos END AS start, pos + len(ref) - 1 + CASE WHEN ins AND len(ref) = 1 THEN 1 ELSE 0 END AS "end", r AS ref, CASE WHEN gt = '0/1' THEN r ELSE a END AS allele1, a AS allele2 FROM g""")
def tabled_events(t):
    """Called alleles as a mutation table has them, the first allele by the genotype."""
    k, size = F.col("p_partkey"), F.col("p_size")
    ref, alt = F.lit("ACGTA").substr(F.lit(1), (size % 3 + 1).cast("int")), F.lit("ACTTG").substr(F.lit(1), (k % 4 + 1).cast("int"))
    return t.part.select("p_partkey", X.tabled_event(k, ref, alt, F.when(size % 2 == 0, "0/1").otherwise("1/1")).alias("e")).select("p_partkey", "e.*")


#: The same of gains, with the limits of another class of samples.
_GAINS = {"x <= cut AS outer_": "x > cut AS outer_", "sum((x > cut)::INT)": "sum((x <= cut)::INT)", "ratio >= 3.7": "ratio >= 3.5", "d >= 1 ": "d >= 0.25 ", "d >= 0.5": "d >= 0.2"}
GAINED = ORACLE_SQL["lost_stretches"]
for _of_losses, _of_gains in _GAINS.items():
    GAINED = GAINED.replace(_of_losses, _of_gains)


@query(GAINED)
def gained_stretches(t):
    return N.intragenic(t.events, ["user_id", "event_type"], "event_id", "value", ratio=3.5, single=0.25, several=0.2, loss=False).select("user_id", "event_type", "n_outer", "run")
