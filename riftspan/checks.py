"""Queries over the given tables, one per operation, each with an equivalent in plain SQL.

``QUERIES`` maps names to functions of ``(spark, sf_dir)``; ``ORACLES`` maps the same names to SQL text.
Every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riftspan import bind
from riftspan.bind import CONFIG, LIBRARY, with_cte
from riftspan.config import ClusterSettings, DepthSettings
from riftspan.functions import calls as cl
from riftspan.functions import cigar as cg
from riftspan.functions import interval as iv
from riftspan.functions import reads as rd
from riftspan.functions.flags import FIRST, has_flag
from riftspan.operators.ordered import consecutive_runs, global_row_number
from riftspan.operators.prefix import count_overlaps
from riftspan.operators.quantiles import exact_quantiles
from riftspan.operators.skew import dealt_out
from riftspan.operators.statistics import median_abs_dev, summary, winsorize
from riftspan.plans import annotate as an
from riftspan.plans import cluster as cu
from riftspan.plans import depth as dp
from riftspan.plans import evidence as ev
from riftspan.plans import scan as sc
from riftspan.plans import standardize as st
from riftspan.plans import unique as un
from riftspan.plans.library import first_pairs, insert_size_model, sample_size

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MIN_CLIP = CONFIG.min_clipped_bases
MAX_NORMAL = LIBRARY.max_normal_isize

#: Read-search distances small enough for the density of the views.
MAX_DIST, SLACK = 100, 20
#: Longest variant annotated in full.
CROP = 400
MIN_BINS = 10

HALF_OVERLAP = ClusterSettings(
    reciprocal_overlap=0.5, max_bp_distance=None, match_strands=False, match_sv_type=True, sample_overlap=None
)


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Enter a query under its name, with its SQL equivalent if there is one."""

    def enter(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return enter


@register(
    "cigar_lengths",
    with_cte(
        """SELECT qname, contig, pos, cigar, left_hard, left_soft, right_hard, right_soft, stop,
        CAST(1 + CASE WHEN clip_left > 0 THEN 1 ELSE 0 END + CASE WHEN clip_right > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_ops FROM reads""",
        "reads",
    ),
)
def cigar_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clip lengths, reference end and number of operations of CIGAR strings."""
    rows = bind.reads(spark, sf_dir, "qname", "contig", "pos", "cigar")
    return rows.select("*", *[c.alias(n) for n, c in cg.clip_columns().items()], cg.end_position().alias("stop"), cg.operation_count().alias("n_ops"))


# --- read predicates -------------------------------------------------------------------------

_ALT = "(flag & 2304) <> 0"
_CLIP = (
    "(({alt}) AND hard AND {side} >= 20) OR (NOT ({alt}) AND {side} >= 20)"
)
_SPLIT_LEFT = "(" + _CLIP.format(alt=_ALT, side="clip_left") + ")"
_SPLIT_RIGHT = "(" + _CLIP.format(alt=_ALT, side="clip_right") + ")"
_DISCORDANT = (
    f"(((flag & 1) <> 0 AND tid >= 0 AND mtid >= 0 AND tid <> mtid) OR abs(tlen) > {MAX_NORMAL}"
    " OR ((flag & 16) <> 0) = ((flag & 32) <> 0))"
)
_INTERESTING = f"((flag & 1548) = 0 AND ({_SPLIT_LEFT} OR {_SPLIT_RIGHT} OR {_DISCORDANT}))"


@register(
    "flag_filter_split",
    with_cte(
        f"SELECT qname, contig, pos, flag, {_SPLIT_LEFT} AS split_left, {_SPLIT_RIGHT} AS split_right "
        f"FROM reads WHERE {_SPLIT_LEFT} OR {_SPLIT_RIGHT}",
        "reads",
    ),
)
def flag_filter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split reads by clipping at either end."""
    return (
        bind.reads(spark, sf_dir)
        .select("qname", "contig", "pos", "flag", rd.split_left(MIN_CLIP).alias("split_left"), rd.split_right(MIN_CLIP).alias("split_right"))
        .filter("split_left OR split_right")
    )


@register(
    "library_sample_reads",
    with_cte(
        "SELECT qname, contig, pos, tlen FROM reads WHERE (flag & 3) = 3 AND (flag & 3852) = 0 AND tlen > 0 AND tid = mtid",
        "reads",
    ),
)
def library_sample_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads that inform the insert-size model."""
    return bind.reads(spark, sf_dir).filter(rd.library_sample()).select("qname", "contig", "pos", "tlen")


@register(
    "discordant_pairs",
    with_cte(f"SELECT qname, contig, pos, flag, tlen FROM reads WHERE {_DISCORDANT}", "reads"),
)
def discordant_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads discordant by contig, insert size or orientation."""
    return bind.reads(spark, sf_dir).filter(rd.discordant(MAX_NORMAL)).select("qname", "contig", "pos", "flag", "tlen")


@register(
    "interesting_reads",
    with_cte(f"SELECT qname, contig, pos, flag FROM reads WHERE {_INTERESTING}", "reads"),
)
def interesting_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable reads with evidence of either kind."""
    return bind.reads(spark, sf_dir).filter(sc.is_interesting(LIBRARY, CONFIG)).select("qname", "contig", "pos", "flag")


@register(
    "mate_rescue_semi",
    with_cte(
        f"SELECT qname, contig, pos, flag FROM reads WHERE qname IN (SELECT qname FROM reads WHERE {_INTERESTING})",
        "reads",
    ),
)
def mate_rescue_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with evidence and all reads of the same templates."""
    rows = bind.reads(spark, sf_dir)
    return sc.with_mates(rows, sc.is_interesting(LIBRARY, CONFIG)).select("qname", "contig", "pos", "flag")


def _regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, c, 0, 2**40) for i, c in enumerate(bind.CONTIGS)], "region_ord int, contig string, start bigint, end bigint"
    )


_OVERLAP = CONFIG.sliding_window_margin + LIBRARY.max_normal_isize + LIBRARY.max_rlen


@register(
    "scan_two_pass",
    with_cte(
        f""", placed AS (
          SELECT r.*, tid AS region_ord, unnest(range(pos // 5000, (pos + {_OVERLAP}) // 5000 + 1)) AS window_no,
                 {_INTERESTING} AS hit
          FROM reads r),
        judged AS (
          SELECT *, max(CAST(hit AS INTEGER)) OVER (PARTITION BY qname ORDER BY region_ord * 1000000000 + window_no, ord
                      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_pass,
                 max(CAST(hit AS INTEGER)) OVER (PARTITION BY qname ORDER BY region_ord * 1000000000 + window_no
                      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS second_pass
          FROM placed)
        SELECT qname, contig, pos, flag, window_no, 1 AS pass FROM judged WHERE first_pass = 1
        UNION ALL
        SELECT qname, contig, pos, flag, window_no, 2 AS pass FROM judged WHERE second_pass = 1""",
        "reads",
    ).replace(") , placed", "), placed"),
)
def scan_two_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emission of the two-pass scan over overlapping windows."""
    rows = bind.reads(spark, sf_dir)
    scanned = sc.two_pass_scan(rows, _regions(spark), LIBRARY, CONFIG, ["ord"])
    return scanned.select("qname", "contig", "pos", "flag", "window_no", "pass")


@register(
    "region_fetch",
    with_cte(
        "SELECT region_ord, qname, contig, pos, stop FROM reads JOIN (VALUES (0, 'F', 1000, 60000), (1, 'P', 500, 9000), "
        "(2, 'F', 50000, 900000000)) AS g(region_ord, name, lo, hi) ON contig = name AND pos < hi AND stop > lo",
        "reads",
    ),
)
def region_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads overlapping listed regions; a read in two overlapping regions comes twice."""
    from riftspan.sources.regions import fetch_regions, parse_regions, region_table

    listed = region_table(spark, parse_regions(_REGION_LIST, compat=True))
    rows = fetch_regions(bind.reads(spark, sf_dir), listed, "contig", F.col("pos"), F.col("stop"))
    return rows.select("region_ord", "qname", "contig", "pos", "stop")


_REGION_LIST = "F:1000-60000,P:500-9000,F:50000-900000000"


@register("region_fetch_staged", ORACLES["region_fetch"])
def region_fetch_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a staged table, of which only files and row groups near the regions are read."""
    from riftspan.session import new_table
    from riftspan.sources.regions import fetch_regions, parse_regions, region_table
    from riftspan.sources.staged import read_staged, stage

    path = new_table(spark)
    stage(bind.reads(spark, sf_dir, "qname", "contig", "pos", "stop"), path, "contig", F.col("pos"), F.col("stop"))
    regions = parse_regions(_REGION_LIST, compat=True)
    rows = fetch_regions(read_staged(spark, path, regions), region_table(spark, regions), "contig", F.col("pos"), F.col("stop"))
    return rows.select("region_ord", "qname", "contig", "pos", "stop")


@register(
    "blocked_anti",
    with_cte(
        """SELECT qname, contig, pos, mcontig, mpos FROM reads r
        WHERE NOT EXISTS (SELECT 1 FROM blocked b WHERE b.contig = r.contig AND r.pos < b.stop AND b.start < r.stop)
          AND NOT ((r.flag & 1) <> 0 AND r.mtid <> -1 AND EXISTS (SELECT 1 FROM blocked b
            WHERE b.contig = r.mcontig AND r.mpos < b.stop AND b.start < r.mpos + 1))""",
        "reads",
        "blocked",
    ),
)
def blocked_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads outside blocked regions, with both their alignment and their mate."""
    kept = sc.drop_blocked_reads(bind.reads(spark, sf_dir), F.col("stop"), bind.blocked(spark, sf_dir))
    return kept.select("qname", "contig", "pos", "mcontig", "mpos")


@register(
    "dedup_first",
    with_cte(
        "SELECT qname, (flag & 64) <> 0 AS is_first, tid, pos, MIN(ord) AS ord FROM reads GROUP BY 1, 2, 3, 4",
        "reads",
    ),
)
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row per template, mate number and position."""
    rows = bind.reads(spark, sf_dir).select("qname", has_flag(FIRST).alias("is_first"), "tid", "pos", "ord")
    return un.first_of_duplicates(rows, ["qname", "is_first", "tid", "pos"], ["ord"]).select(
        "qname", "is_first", "tid", "pos", "ord"
    )


@register(
    "qname_islands",
    """SELECT event_id, event_type, CAST(SUM(new) OVER (ORDER BY event_id) AS BIGINT) AS run_id FROM (
         SELECT event_id, event_type, CASE WHEN event_id = MIN(event_id) OVER () THEN 0
           WHEN LAG(event_type) OVER (ORDER BY event_id) = event_type THEN 0 ELSE 1 END AS new FROM events)""",
)
def qname_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of the run of equal consecutive names each row belongs to."""
    rows = bind.table(spark, sf_dir, "events").select("event_id", "event_type", F.expr("event_id div 4096").alias("block"))
    return consecutive_runs(rows, "event_type", ["block"], ["event_id"], "run_id").drop("block")


@register(
    "unique_read_tags",
    """WITH runs AS (SELECT *, CAST(SUM(new) OVER (ORDER BY event_id) AS BIGINT) AS read_id FROM (
         SELECT event_id, event_type, user_id, CASE WHEN event_id = MIN(event_id) OVER () THEN 0
           WHEN LAG(event_type) OVER (ORDER BY event_id) = event_type THEN 0 ELSE 1 END AS new FROM events))
       SELECT MIN(event_id) AS ord, event_type AS qname, user_id % 2 AS tid, read_id FROM runs
       GROUP BY read_id, event_type, user_id % 4 >= 2, user_id % 2, user_id % 3""",
)
def unique_read_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate removal inside runs of equal names, with the run number as read id."""
    rows = bind.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("ord"),
        F.expr("event_id div 4096").alias("block"),
        F.col("event_type").alias("qname"),
        F.when(F.col("user_id") % 4 >= 2, FIRST).otherwise(0).alias("flag"),
        (F.col("user_id") % 2).alias("tid"),
        (F.col("user_id") % 3).alias("pos"),
    )
    return un.unique_reads(rows, ["block"], ["ord"]).select("ord", "qname", "tid", "read_id")


# --- evidence --------------------------------------------------------------------------------

_SIDES = f"CASE WHEN {_SPLIT_LEFT} AND {_SPLIT_RIGHT} THEN 'Both' WHEN {_SPLIT_LEFT} THEN 'Left' ELSE 'Right' END"
_STRAND1 = "CASE WHEN (flag & 16) <> 0 THEN 'Reverse' ELSE 'Forward' END"
_STRAND2 = "CASE WHEN (flag & 32) <> 0 THEN 'Reverse' ELSE 'Forward' END"
_EVIDENCE_SQL = f"""evidence AS (
  SELECT 'SplitRead' AS kind, qname AS read_id, (flag & 64) <> 0 AS is_first, contig, pos AS "start", stop AS "end",
         NULL AS strand1, NULL AS contig2, NULL AS start2, NULL AS strand2, NULL AS tlen, {_SIDES} AS clipped_sides
  FROM reads WHERE {_SPLIT_LEFT} OR {_SPLIT_RIGHT}
  UNION ALL
  SELECT 'PairedRead', qname, (flag & 64) <> 0, contig, pos, stop, {_STRAND1},
         CASE WHEN (flag & 1) <> 0 AND mtid >= 0 THEN mcontig END, CASE WHEN (flag & 1) <> 0 THEN mpos END,
         CASE WHEN (flag & 1) <> 0 THEN {_STRAND2} END, CASE WHEN (flag & 1) <> 0 AND tlen >= 0 THEN tlen END, NULL
  FROM reads WHERE {_DISCORDANT})"""
_EVIDENCE_COLUMNS = [
    "kind", "read_id", "is_first", "contig", "start", "end", "strand1", "contig2", "start2", "strand2", "tlen", "clipped_sides"
]


def _with_evidence(sql: str, *views: str) -> str:
    return with_cte(", " + _EVIDENCE_SQL + " " + sql, *views).replace(") , evidence", "), evidence")


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.reads(spark, sf_dir).withColumn("end", F.col("stop")).withColumn("read_id", F.col("qname"))
    return ev.extract_evidence(rows, MAX_NORMAL, MIN_CLIP)


@register(
    "pe_sr_explode",
    _with_evidence("SELECT " + ", ".join(f'"{c}"' for c in _EVIDENCE_COLUMNS) + " FROM evidence", "reads"),
)
def pe_sr_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split-read and paired-end evidence rows."""
    return _evidence(spark, sf_dir).select(*_EVIDENCE_COLUMNS)


_Q = "'\"' || {0} || '\"'"
_OR_NULL = "COALESCE({0}, 'null')"
_JSON_SQL = (
    "CASE WHEN kind = 'SplitRead' THEN '{\"SplitRead\":{\"read_id\":' || read_id || ',\"is_first\":' || CAST(is_first AS VARCHAR) || "
    "',\"contig\":\"' || contig || '\",\"start\":' || \"start\" || ',\"end\":' || \"end\" || ',\"clipped_sides\":\"' || clipped_sides || '\"}}' "
    "ELSE '{\"PairedRead\":{\"read_id\":' || read_id || ',\"is_first1\":' || CAST(is_first AS VARCHAR) || ',\"contig1\":\"' || contig || "
    "'\",\"start1\":' || \"start\" || ',\"end1\":' || \"end\" || ',\"strand1\":\"' || strand1 || '\",\"contig2\":' || "
    + _OR_NULL.format(_Q.format("contig2"))
    + " || ',\"start2\":' || COALESCE(CAST(start2 AS VARCHAR), 'null') || ',\"strand2\":' || "
    + _OR_NULL.format(_Q.format("strand2"))
    + " || ',\"tlen\":' || COALESCE(CAST(tlen AS VARCHAR), 'null') || '}}' END"
)


@register(
    "evidence_json",
    _with_evidence(f'SELECT contig, "start", "end", {_JSON_SQL} AS signal FROM evidence', "reads"),
)
def evidence_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence as the lines of an evidence file, after a round trip through its JSON form."""
    rows = _evidence(spark, sf_dir)
    again = ev.from_signal(rows.select(ev.signal_json(rows).alias("signal")), F.col("signal"))
    return again.select("contig", "start", "end", ev.signal_json(again).alias("signal"))


@register(
    "event_json_fields",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def event_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of a JSON column."""
    rows = bind.table(spark, sf_dir, "events")
    return rows.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@register(
    "blocked_evidence",
    _with_evidence(
        """SELECT kind, read_id, contig, "start", "end" FROM evidence e
        WHERE NOT EXISTS (SELECT 1 FROM blocked b WHERE b.contig = e.contig AND e."start" < b.stop AND b.start < e."end")
          AND NOT EXISTS (SELECT 1 FROM blocked b WHERE b.contig = e.contig2 AND e.start2 < b.stop AND b.start < e.start2 + 1)""",
        "reads",
        "blocked",
    ),
)
def blocked_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence whose ends lie outside blocked regions."""
    kept = an.drop_blocked_evidence(
        _evidence(spark, sf_dir), bind.blocked(spark, sf_dir)
    )
    return kept.select("kind", "read_id", "contig", "start", "end")


_BEFORE = f"greatest({{0}} - {MAX_DIST}, 0)"
_L = MAX_DIST + SLACK


def _windows_sql(name: str = "windows") -> str:
    def rows(cond: str, pair: int, side: int, start: str, strand: str) -> str:
        contig = "chrom" if side == 1 else "chrom2"
        return (
            f"SELECT row_id, {pair} AS pair, {side} AS side, {contig} AS contig, {start} AS lo, {start} + {_L} AS hi, "
            f"'{strand}' AS strand FROM svs WHERE {cond}"
        )

    before_pos, before_end = _BEFORE.format("pos"), _BEFORE.format("end2")
    near_pos, near_end = f"pos - {SLACK}", f"end2 - {SLACK}"
    deletion = "(sv_type = 'DEL' OR (sv_type = 'BND' AND strands = '+-'))"
    same = "(sv_type = 'BND' AND strands IN ('--', '++'))"
    inward = "(sv_type = 'BND' AND strands = '-+')"
    parts = [
        rows(deletion, 1, 1, before_pos, "Forward"),
        rows(deletion, 1, 2, near_end, "Reverse"),
        rows("sv_type = 'DUP'", 1, 1, near_pos, "Reverse"),
        rows("sv_type = 'DUP'", 1, 2, f"end2 - {MAX_DIST}", "Forward"),
        rows("sv_type = 'INV'", 1, 1, before_pos, "Forward"),
        rows("sv_type = 'INV'", 1, 2, before_end, "Forward"),
        rows("sv_type = 'INV'", 2, 1, near_pos, "Reverse"),
        rows("sv_type = 'INV'", 2, 2, before_end, "Reverse"),
        rows(same, 1, 1, near_pos, "Reverse"),
        rows(same, 1, 2, near_end, "Reverse"),
        rows(inward, 1, 1, near_pos, "Reverse"),
        rows(inward, 1, 2, before_end, "Reverse"),
    ]
    return f"{name} AS (" + " UNION ALL ".join(parts) + ")"


@register(
    "search_windows",
    with_cte(f", {_windows_sql()} SELECT * FROM windows", "svs").replace(") , windows", "), windows"),
)
def search_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stranded windows in which reads supporting a variant are sought."""
    rows = bind.svs(spark, sf_dir).select("row_id", F.explode(an.search_windows(MAX_DIST, SLACK)).alias("_w"))
    return rows.select("row_id", "_w.*").withColumns({c: F.col(c).cast("int") for c in ("pair", "side")})


@register(
    "interval_overlap_join",
    with_cte(
        """SELECT row_id, CAST(COUNT(r.contig) AS BIGINT) AS n_overlaps FROM svs
        LEFT JOIN reads r ON r.contig = chrom AND r.pos < end2 AND r.stop > svs.pos GROUP BY row_id""",
        "svs",
        "reads",
    ),
)
def interval_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads overlapping each variant, counted without listing them."""
    variants = bind.svs(spark, sf_dir).select("row_id", F.col("chrom").alias("contig"), "pos", "end2")
    rows = bind.reads(spark, sf_dir, "contig", "pos", "stop")
    return count_overlaps(variants, ["row_id"], "contig", (F.col("pos"), F.col("end2")), rows, ("pos", "stop"))


@register(
    "evidence_support",
    _with_evidence(
        f""", {_windows_sql()}, hits AS (
          SELECT DISTINCT w.row_id, w.pair, w.side, e.kind, e.read_id, e.kind = 'SplitRead' AND e.is_first AS mate
          FROM windows w JOIN evidence e ON e.contig = w.contig AND e."start" < w.hi AND w.lo < e."end"
            AND CASE WHEN e.kind = 'PairedRead' THEN e.strand1 = w.strand ELSE e.clipped_sides = 'Both'
              OR (e.clipped_sides = 'Right' AND w.strand = 'Forward') OR (e.clipped_sides = 'Left' AND w.strand = 'Reverse') END),
        paired AS (SELECT row_id, kind, pair, read_id, mate FROM hits GROUP BY ALL HAVING COUNT(DISTINCT side) = 2)
        SELECT row_id, CAST(SUM(CASE WHEN kind = 'PairedRead' THEN 1 ELSE 0 END) AS BIGINT) AS pe_count,
               CAST(SUM(CASE WHEN kind = 'SplitRead' THEN 1 ELSE 0 END) AS BIGINT) AS sr_count FROM paired GROUP BY row_id""",
        "reads",
        "svs",
    ).replace(") , windows", "), windows"),
)
def evidence_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates supporting each variant on both sides."""
    return an.evidence_counts(bind.svs(spark, sf_dir), _evidence(spark, sf_dir), MAX_DIST, SLACK)


# --- calls and clusters ----------------------------------------------------------------------

_CALLER_SQL = """
SELECT o_orderkey AS row_id, o_orderstatus AS chrom, o_orderkey * 8 AS pos, o_custkey % 300 AS shift,
       CASE o_custkey % 5 WHEN 0 THEN 'PASS' WHEN 1 THEN 'LowQual' WHEN 2 THEN '' ELSE 'PASS' END AS filter_text,
       CASE o_orderkey % 6 WHEN 0 THEN 'DEL' WHEN 1 THEN 'DUP' WHEN 2 THEN 'INV' WHEN 3 THEN 'BND' WHEN 4 THEN 'INS' ELSE 'DEL' END AS kind,
       CASE o_custkey % 4 WHEN 0 THEN '5to3' WHEN 1 THEN '3to5' WHEN 2 THEN '5to5' ELSE '3to3' END AS ct,
       CASE o_custkey % 4 WHEN 0 THEN ']X:' || CAST(o_custkey AS VARCHAR(20)) || ']A'
                          WHEN 1 THEN 'A[X:' || CAST(o_custkey AS VARCHAR(20)) || '['
                          WHEN 2 THEN '[X:' || CAST(o_custkey AS VARCHAR(20)) || '[A'
                          ELSE 'A]X:' || CAST(o_custkey AS VARCHAR(20)) || ']' END AS breakend,
       CASE o_custkey % 6 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' WHEN 2 THEN './.' WHEN 3 THEN '1' WHEN 4 THEN './2' ELSE '0|1' END AS gt
FROM orders
"""


def _caller_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant rows as a caller would write them."""
    base = spark.sql(_CALLER_SQL.replace("FROM orders", "FROM {given}"), given=bind.table(spark, sf_dir, "orders"))
    end = (F.col("pos") + 50 + F.col("shift")).cast("string")
    none = F.lit(None).cast("string")
    info = F.create_map(
        F.lit("SVTYPE"), F.col("kind"),
        F.lit("CHR2"), F.concat(F.col("chrom"), F.lit("2")),
        F.lit("CT"), F.col("ct"),
        F.lit("END"), end,
        F.lit("END2"), F.when(F.col("row_id") % 7 == 0, (F.col("pos") + 1000).cast("string")),
        F.lit("INV3"), F.when(F.col("shift") % 2 == 0, F.lit("")),
    )
    fields = F.create_map(F.lit("GT"), F.col("gt"))
    return base.select(
        "row_id",
        "chrom",
        "pos",
        F.lit("ACG").alias("ref"),
        F.array(F.when(F.col("kind") == "BND", F.col("breakend")).otherwise(F.concat(F.lit("<"), F.col("kind"), F.lit(">")))).alias("alts"),
        F.filter(F.array(F.when(F.col("filter_text") != "", F.col("filter_text")).otherwise(none)), lambda f: f.isNotNull()).alias("filters"),
        info.alias("info"),
        F.array(F.struct(F.lit("S0").alias("sample"), fields.alias("fields"))).alias("calls"),
    )


_CALLED = "CAST(gt IN ('0/1', '1', './2', '0|1') AS INTEGER)"
_END2 = "CASE WHEN row_id % 7 = 0 THEN pos + 1000 ELSE pos + 50 + shift END"
_KEPT = "filter_text <> 'LowQual'"


def _standardized(rows: DataFrame) -> DataFrame:
    call = F.get("calls", F.lit(0))
    return rows.select(
        "row_id", "chrom", "pos", "reference", "alt", "end2", "chrom2", "sv_type", "strands", "sv_len",
        call["gt"].alias("gt"), call["called"].alias("called"),
    )


@register(
    "standardize_strands",
    f"""WITH caller AS ({_CALLER_SQL})
    SELECT row_id, chrom, pos, 'ACG' AS reference, CASE WHEN kind = 'BND' THEN breakend ELSE '<' || kind || '>' END AS alt,
      {_END2} AS end2, chrom || '2' AS chrom2, kind AS sv_type,
      CASE ct WHEN '5to3' THEN '-+' WHEN '3to5' THEN '+-' WHEN '5to5' THEN '--' ELSE '++' END AS strands,
      CASE WHEN kind = 'BND' THEN -1 ELSE {_END2} - pos END AS sv_len, gt, {_CALLED} AS called
    FROM caller WHERE kind <> 'INS' AND {_KEPT}""",
)
def standardize_strands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dialect brought into the common layout."""
    return _standardized(st.standardize(_caller_rows(spark, sf_dir), "delly", True, ("row_id",)))


@register(
    "bnd_parse",
    f"""WITH caller AS ({_CALLER_SQL})
    SELECT row_id, chrom, pos, 'A' AS reference, CASE WHEN kind = 'BND' THEN breakend ELSE '<' || kind || '>' END AS alt,
      CASE WHEN kind = 'BND' THEN CAST(regexp_extract(breakend, '.*[\\[\\]](.+):(.+)[\\[\\]].*', 2) AS BIGINT) ELSE pos + 50 + shift END AS end2,
      CASE WHEN kind = 'BND' THEN regexp_extract(breakend, '.*[\\[\\]](.+):(.+)[\\[\\]].*', 1) ELSE chrom END AS chrom2, kind AS sv_type,
      CASE kind WHEN 'DEL' THEN '+-' WHEN 'DUP' THEN '-+' WHEN 'INV' THEN CASE WHEN shift % 2 = 0 THEN '++' ELSE '--' END
        ELSE CASE WHEN breakend LIKE '%[' THEN '+-' WHEN breakend LIKE '%]' THEN '++' WHEN breakend LIKE ']%' THEN '-+' ELSE '--' END END AS strands,
      CASE WHEN kind = 'BND' THEN -1 ELSE 50 + shift END AS sv_len, gt, {_CALLED} AS called
    FROM caller WHERE kind <> 'INS'""",
)
def bnd_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dialect with breakend notation brought into the common layout, unfiltered."""
    return _standardized(st.standardize(_caller_rows(spark, sf_dir), "manta", False, ("row_id",)))


@register(
    "depth_caller_rows",
    f"""WITH caller AS ({_CALLER_SQL})
    SELECT row_id, chrom, pos, 'ACG' AS reference, CASE WHEN kind = 'BND' THEN breakend ELSE '<' || kind || '>' END AS alt,
      pos + 50 + shift AS end2, chrom AS chrom2, kind AS sv_type, CAST(NULL AS VARCHAR) AS strands, 50 + shift AS sv_len,
      gt, {_CALLED} AS called
    FROM caller WHERE {_KEPT}""",
)
def depth_caller_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dialect without strands brought into the common layout."""
    return _standardized(st.standardize(_caller_rows(spark, sf_dir), "cnmops", True, ("row_id",)))


@register(
    "filter_pass",
    f"WITH caller AS ({_CALLER_SQL}) SELECT row_id, filter_text FROM caller WHERE {_KEPT} AND kind <> 'INS'",
)
def filter_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a failed filter that are no insertions."""
    rows = _caller_rows(spark, sf_dir)
    kept = rows.filter(cl.passes_filters(F.col("filters"))).filter(F.col("info")["SVTYPE"] != "INS")
    return kept.select("row_id", F.concat_ws(";", "filters").alias("filter_text"))


@register(
    "sv_intervals",
    with_cte(
        """SELECT row_id, CASE WHEN sv_type = 'BND' THEN pos ELSE least(pos, end2) END - 10 AS lo,
        CASE WHEN sv_type = 'BND' THEN pos + 1 ELSE greatest(pos, end2) END + 10 AS hi,
        greatest(least(CASE WHEN sv_type = 'BND' THEN pos + 1 ELSE end2 END, pos + 150) - greatest(pos, pos + 20), 0) AS shared
        FROM svs""",
        "svs",
    ),
)
def sv_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant intervals widened on both sides, and their overlap with a fixed stretch."""
    lo, hi = iv.sv_interval(F.col("pos"), F.col("end2"), F.col("sv_type"))
    return bind.svs(spark, sf_dir).select(
        "row_id",
        (lo - 10).alias("lo"),
        (hi + 10).alias("hi"),
        iv.overlap_length(lo, hi, F.col("pos") + 20, F.col("pos") + 150).cast("bigint").alias("shared"),
    )


_LABELS_SQL = """
iv AS (SELECT *, CASE WHEN sv_type = 'BND' THEN pos + 1 ELSE end2 END AS stop FROM svs WHERE sv_type IN ('DEL', 'DUP', 'INV', 'BND')),
edges AS (
  SELECT a.row_id AS a, b.row_id AS b FROM iv a JOIN iv b ON a.chrom = b.chrom AND a.sv_type = b.sv_type
    AND a.pos < b.stop AND b.pos < a.stop
    AND 2 * (least(a.stop, b.stop) - greatest(a.pos, b.pos)) >= greatest(a.stop - a.pos, b.stop - b.pos)),
reach AS (
  SELECT row_id AS a, row_id AS b FROM iv
  UNION
  SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
labels AS (SELECT a AS row_id, MIN(b) AS cluster FROM reach GROUP BY a)
"""


def _with_labels(sql: str) -> str:
    text = with_cte(", " + _LABELS_SQL + sql, "svs").replace(") , \niv", "),\niv")
    return text.replace("WITH svs", "WITH RECURSIVE svs", 1)


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cu.assign_clusters(bind.svs(spark, sf_dir), HALF_OVERLAP)


@register("sv_clusters", _with_labels("SELECT row_id, cluster FROM labels"))
def sv_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of variants of one type linked by reciprocal overlap."""
    return _clustered(spark, sf_dir).select("row_id", "cluster")


DISTANCE = ClusterSettings(reciprocal_overlap=0.1, max_bp_distance=300, match_strands=True, match_sv_type=True, sample_overlap=None)
_DISTANCE_EDGES = """a.strands = b.strands AND abs(a.pos - b.pos) <= 300 AND abs(a.stop - b.stop) <= 300
    AND 10 * (least(a.stop, b.stop) - greatest(a.pos, b.pos)) >= greatest(a.stop - a.pos, b.stop - b.pos)"""
_OVERLAP_EDGES = """a.pos < b.stop AND b.pos < a.stop
    AND 2 * (least(a.stop, b.stop) - greatest(a.pos, b.pos)) >= greatest(a.stop - a.pos, b.stop - b.pos)"""


@register("sv_clusters_distance", _with_labels("SELECT row_id, cluster FROM labels").replace(_OVERLAP_EDGES, _DISTANCE_EDGES))
def sv_clusters_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters by breakpoint distance, strands and a little overlap: the default for read-based callers."""
    return cu.assign_clusters(bind.svs(spark, sf_dir), DISTANCE).select("row_id", "cluster")


@register(
    "sv_clusters_samples", _with_labels("SELECT row_id, cluster FROM labels").replace(_OVERLAP_EDGES, _OVERLAP_EDGES + " AND a.sample = b.sample")
)
def sv_clusters_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters by overlap that must share samples as well."""
    return cu.assign_clusters(bind.svs(spark, sf_dir), replace(HALF_OVERLAP, sample_overlap=0.5)).select("row_id", "cluster")


_SETS_SQL = (
    _with_labels("SELECT row_id, cluster FROM labels")
    .replace("iv AS (SELECT *,", "iv AS (SELECT *, list_distinct(list_transform(range(0, row_id % 20 + 1), lambda k: (sv_len + k * k * 7) % 40)) AS samples,")
    .replace(_OVERLAP_EDGES, _OVERLAP_EDGES + " AND 2 * len(list_intersect(a.samples, b.samples)) >= greatest(len(a.samples), len(b.samples))")
)


@register("sv_clusters_sets", _SETS_SQL)
def sv_clusters_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters by overlap of variants with up to twenty samples, half of which must be the same."""
    svs = bind.svs(spark, sf_dir)
    sample = lambda k: F.concat(F.lit("S"), ((F.col("sv_len") + k * k * 7) % 40).cast("string"))
    call = lambda k: F.get("calls", F.lit(0)).withField("sample", sample(k))
    svs = svs.withColumn("calls", F.transform(F.sequence(F.lit(0).cast("long"), F.col("row_id") % 20), call))
    return cu.assign_clusters(svs, replace(HALF_OVERLAP, sample_overlap=0.5)).select("row_id", "cluster")


@register(
    "cluster_callers",
    _with_labels(
        """, m AS (SELECT l.cluster, s.* FROM labels l JOIN svs s USING (row_id))
        SELECT cluster, sample, array_to_string(list_sort(list(DISTINCT CASE WHEN row_id % 5 = 0 THEN 'manta' ELSE 'delly' END)), ',') AS callers
        FROM m GROUP BY cluster, sample"""
    ),
)
def cluster_callers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Callers of each sample, united over the variants of its cluster."""
    caller = F.array(F.when(F.col("row_id") % 5 == 0, "manta").otherwise("delly"))
    rows = _clustered(spark, sf_dir).withColumn("calls", F.transform("calls", lambda c: c.withField("called_by", caller)))
    calls = cu.merged_calls(rows).select("cluster", F.explode("calls").alias("c"))
    return calls.select("cluster", "c.sample", F.array_join("c.called_by", ",").alias("callers"))


@register(
    "standardized_back",
    with_cte(
        """SELECT row_id, chrom, pos, 'v' || CAST(row_id AS VARCHAR) AS sv_id, chrom2, end2, sv_type,
          CASE WHEN row_id % 4 = 0 THEN '.' ELSE strands END AS strands, sv_len,
          CASE WHEN row_id % 2 = 0 THEN 'delly' ELSE 'delly+manta' END AS algorithms,
          sample || '=' || CASE row_id % 3 WHEN 0 THEN '0-1' WHEN 1 THEN '.-.' ELSE '1-1' END || '=' || CASE WHEN row_id % 5 = 0 THEN '' ELSE 'delly' END AS call
        FROM svs""",
        "svs",
    ),
)
def standardized_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants of the common layout read back from their file columns."""
    rows = bind.svs(spark, sf_dir)
    row = F.col("row_id")
    text = {"CHR2": F.col("chrom2"), "END2": F.col("end2").cast("string"), "SVTYPE": F.col("sv_type"), "SVLEN": F.col("sv_len").cast("string"),
            "STRANDS": F.when(row % 4 != 0, F.col("strands")), "ALGORITHMS": F.when(row % 2 == 0, "delly").otherwise("delly,manta")}
    gt = F.when(row % 3 == 0, "0/1").when(row % 3 == 1, "./.").otherwise("1|1")
    fields = F.create_map(F.lit("GT"), gt, F.lit("delly"), F.when(row % 5 == 0, "0").otherwise("1"))
    variants = rows.select(
        "row_id", "chrom", "pos", F.concat(F.lit("v"), row.cast("string")).alias("id"), F.lit("A").alias("ref"), F.array("alt").alias("alts"),
        F.array().cast("array<string>").alias("filters"),
        F.create_map(*[x for name, value in text.items() for x in (F.lit(name), value)]).alias("info"),
        F.array(F.struct(F.col("sample"), fields.alias("fields"))).alias("calls"),
    )
    call = F.get("calls", F.lit(0))
    return st.parse_standardized(variants, ("row_id",)).select(
        "row_id", "chrom", "pos", "sv_id", "chrom2", "end2", "sv_type", "strands", "sv_len", F.array_join("algorithms", "+").alias("algorithms"),
        F.concat_ws("=", call["sample"], call["gt"], F.array_join(call["called_by"], "+")).alias("call"),
    )


@register(
    "cluster_consensus",
    _with_labels(
        """, m AS (SELECT l.cluster, s.* FROM labels l JOIN svs s USING (row_id)),
        p AS (SELECT cluster, list_sort(list(pos)) AS ps, list_sort(list(end2)) AS es, COUNT(*) AS n,
                list_sort(list(DISTINCT CASE WHEN row_id % 2 = 0 THEN 'delly' ELSE 'manta' END)) AS al FROM m GROUP BY cluster),
        q AS (SELECT p.*, h.chrom, h.sv_type, h.strands, (ps[(n - 1) // 2 + 1] + ps[n // 2 + 1]) // 2 AS mid,
                (es[(n - 1) // 2 + 1] + es[n // 2 + 1]) // 2 AS mid2 FROM p JOIN svs h ON h.row_id = p.cluster)
        SELECT cluster, chrom, mid AS pos, CASE WHEN sv_type = 'BND' THEN mid + 1 ELSE mid2 END AS end2, sv_type, strands,
          CASE WHEN sv_type = 'BND' THEN -1 ELSE mid2 - mid END AS sv_len, array_to_string(al, ',') AS algorithms,
          (SELECT string_agg(sample || '=' || gt, ';' ORDER BY sample) FROM (
             SELECT sample, CASE WHEN COUNT(*) = 1 THEN MIN(CASE WHEN row_id % 3 = 0 THEN '1-1' ELSE '0-1' END)
               WHEN MAX(CASE WHEN row_id % 3 = 0 THEN 2 ELSE 1 END) = 2 THEN '1/1' ELSE '0/1' END AS gt
             FROM m WHERE m.cluster = q.cluster GROUP BY sample)) AS genotypes
        FROM q"""
    ),
)
def cluster_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per cluster: median ends, callers and merged genotypes."""
    records = cu.collapse_clusters(_clustered(spark, sf_dir), HALF_OVERLAP)
    genotypes = F.array_sort(F.transform("calls", lambda c: F.concat(c["sample"], F.lit("="), c["gt"])))
    return records.select(
        "cluster", "chrom", "pos", "end2", "sv_type", "strands", "sv_len",
        F.array_join("algorithms", ",").alias("algorithms"),
        F.array_join(genotypes, ";").alias("genotypes"),
    )


@register(
    "sv_numbering",
    with_cte(
        """SELECT row_id, chrom, pos, end2, 'SV' || lpad(CAST(ROW_NUMBER() OVER (ORDER BY chrom, pos, end2, sv_type, row_id) AS VARCHAR), 8, '0') AS sv_id
        FROM svs""",
        "svs",
    ),
)
def sv_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running ids in output order."""
    rows = bind.svs(spark, sf_dir).select("row_id", "chrom", "pos", "end2", "sv_type")
    numbered = global_row_number(rows, ["chrom", "pos", "end2", "sv_type", "row_id"], "number")
    return numbered.select("row_id", "chrom", "pos", "end2", F.format_string("SV%08d", "number").alias("sv_id"))


@register(
    "sample_matrix",
    with_cte(
        "SELECT row_id, "
        + ", ".join(
            f"COALESCE(MAX(CASE WHEN sample = 'S{i}' THEN CASE WHEN row_id % 3 = 0 THEN '1/1' ELSE '0/1' END END), './.') AS gt_{i}"
            for i in range(8)
        )
        + " FROM svs GROUP BY row_id",
        "svs",
    ),
)
def sample_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genotype columns per sample; samples without a call are missing."""
    wide = cu.sample_matrix(bind.svs(spark, sf_dir), ["row_id"], [f"S{i}" for i in range(8)])
    cells = [
        F.when(F.col("cells")[i]["gt"] == "./.", "./.").otherwise(cl.clustered_genotype(F.col("cells")[i]["gt"])).alias(f"gt_{i}")
        for i in range(8)
    ]
    return wide.select("row_id", *cells)


# --- depth -----------------------------------------------------------------------------------

SHORT_WINDOWS = DepthSettings(window_length=100, count_kind="coverage", min_mapq=20)
FRAGMENTS = DepthSettings(window_length=100, count_kind="fragments", min_mapq=20)


def _contig_lengths(rows: DataFrame) -> DataFrame:
    return rows.groupBy("contig").agg((F.max("stop") + 1000).alias("length"))


_LENGTHS_SQL = ", lens AS (SELECT contig, MAX(stop) + 1000 AS length FROM reads GROUP BY contig), spine AS (SELECT contig, unnest(range(0, (length - 1) // 100 + 1)) AS window_id FROM lens)"
_COUNTED_SQL = "(flag & 3840) = 0 AND mapq >= 20 AND ((flag & 1) = 0 OR (flag & 2) <> 0)"


def _thousandths_sql(expr: str) -> str:
    """A single-precision value to three digits, by operations that all engines round alike."""
    return f"floor(CAST(CAST({expr} AS FLOAT) AS DOUBLE) * 1000 + 0.5) / 1000"


def _thousandths(name: str) -> Column:
    return (F.floor(F.col(name).cast("double") * 1000 + 0.5) / 1000).alias(name)


def _with_spine(sql: str) -> str:
    return with_cte(_LENGTHS_SQL + " " + sql, "reads").replace(") , lens", "), lens")


@register(
    "fragment_windows",
    _with_spine(
        f""", frag AS (SELECT contig, (CASE WHEN (flag & 1) <> 0 THEN pos + tlen // 2 ELSE (pos + stop) // 2 END) // 100 AS window_id, mapq
          FROM reads WHERE {_COUNTED_SQL} AND ((flag & 1) = 0 OR tlen > 0)
            AND NOT CAST(CAST(seq_len - clip_left - clip_right AS DOUBLE) / seq_len AS FLOAT) < CAST(0.6 AS FLOAT)),
        agg AS (SELECT contig, window_id, COUNT(*) AS n, AVG(mapq) AS q FROM frag GROUP BY 1, 2)
        SELECT contig, window_id, CAST(COALESCE(n, 0) AS DOUBLE) AS cov, {_thousandths_sql("COALESCE(q, 0)")} AS mean_mapq
        FROM spine LEFT JOIN agg USING (contig, window_id)"""
    ),
)
def fragment_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments per window, empty windows included."""
    rows = bind.reads(spark, sf_dir).withColumn("end", F.col("stop"))
    out = dp.depth_windows(rows, _contig_lengths(rows), FRAGMENTS)
    return out.select(
        "contig", "window_id", F.col("cov").cast("double").alias("cov"), _thousandths("mean_mapq")
    )


@register(
    "coverage_windows",
    _with_spine(
        f""", bases AS (SELECT contig, unnest(range(pos, stop)) AS p, mapq FROM reads WHERE (flag & 4) = 0 AND {_COUNTED_SQL}),
        d AS (SELECT contig, p, COUNT(*) AS depth, SUM(mapq) AS q FROM bases GROUP BY 1, 2),
        agg AS (SELECT contig, p // 100 AS window_id, SUM(depth) AS s, SUM(depth * depth) AS s2, SUM(q) AS q FROM d GROUP BY 1, 2)
        SELECT contig, window_id, {_thousandths_sql("COALESCE(CAST(s AS DOUBLE) / 100, 0)")} AS cov,
          {_thousandths_sql("COALESCE(sqrt((s2 - s * (CAST(s AS DOUBLE) / 100)) / 99), 0)")} AS cov_sd,
          {_thousandths_sql("COALESCE(CAST(q AS DOUBLE) / s, 0)")} AS mean_mapq
        FROM spine LEFT JOIN agg USING (contig, window_id)"""
    ),
)
def coverage_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation of base coverage per window."""
    rows = bind.reads(spark, sf_dir).withColumn("end", F.col("stop"))
    out = dp.depth_windows(rows, _contig_lengths(rows), SHORT_WINDOWS)
    return out.select(
        "contig",
        "window_id",
        *[_thousandths(c) for c in ("cov", "cov_sd", "mean_mapq")],
    )


_LETTERS = "length(regexp_replace(piece, '[^{0}]', '', 'g'))"


@register(
    "depth_counters",
    with_cte(
        f"""SELECT 'coverage' AS kind, COUNT(*) AS processed, COUNT(*) - COUNT(*) FILTER (WHERE (flag & 4) = 0 AND {_COUNTED_SQL}) AS skipped FROM reads
        UNION ALL SELECT 'fragments', COUNT(*), COUNT(*) - COUNT(*) FILTER (WHERE {_COUNTED_SQL} AND ((flag & 1) = 0 OR tlen > 0)
            AND NOT CAST(CAST(seq_len - clip_left - clip_right AS DOUBLE) / seq_len AS FLOAT) < CAST(0.6 AS FLOAT)) FROM reads""",
        "reads",
    ),
)
def depth_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads processed and skipped while windows of depth are computed."""
    rows = bind.reads(spark, sf_dir).withColumn("end", F.col("stop"))
    found = []
    for settings in (SHORT_WINDOWS, FRAGMENTS):
        counters = Observation()
        windows = dp.depth_windows(dp.count_rows(rows, settings, counters), _contig_lengths(rows), settings)
        windows.write.format("noop").mode("overwrite").save()
        found.append((settings.count_kind, *(dp.counted_rows(counters) or (0, 0))))
    return spark.createDataFrame(found, "kind string, processed bigint, skipped bigint")


@register(
    "gc_content",
    f"""WITH pieces AS (SELECT doc_id, b AS window_id, substr(text, CAST(b * 100 + 1 AS BIGINT), 100) AS piece
          FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 99) // 100)) AS b FROM documents)),
        counts AS (SELECT doc_id, window_id, {_LETTERS.format("gcGC")} AS gc, {_LETTERS.format("gcatGCAT")} AS acgt,
          {_LETTERS.format("nN")} AS n FROM pieces)
        SELECT doc_id, window_id, ROUND(CASE WHEN acgt > 0 THEN CAST(gc AS DOUBLE) / acgt END, 4) AS gc, n > 0 AS has_gap FROM counts""",
)
def gc_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G/C share and presence of N per stretch of 100 characters."""
    chunks = F.regexp_extract_all("text", F.lit("(?s).{1,100}"), F.lit(0))
    docs = dealt_out(bind.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    pieces = docs.select("doc_id", F.posexplode(chunks).alias("window_id", "piece"))
    out = dp.composition(pieces, ["doc_id", "window_id"], "piece")
    return out.select(
        "doc_id", F.col("window_id").cast("bigint").alias("window_id"), F.round(F.col("gc").cast("double"), 4).alias("gc"), "has_gap"
    )


@register(
    "window_composition",
    """WITH w AS (SELECT doc_id AS contig, unnest(range(0, (length(text) + 99) // 100)) AS window_id, n_chars AS cov, text FROM documents),
       r AS (SELECT contig, window_id, cov, substr(text, window_id * 100 + 1, 100) AS t FROM w),
       p AS (SELECT contig, window_id, cov, length(regexp_replace(t, '[^gcGC]', '', 'g')) AS gc,
          length(regexp_replace(t, '[^gcatGCAT]', '', 'g')) AS acgt, length(regexp_replace(t, '[^nN]', '', 'g')) AS n FROM r)
       SELECT contig, window_id, cov, ROUND(CASE WHEN acgt > 0 THEN CAST(gc AS DOUBLE) / acgt END, 4) AS gc, n > 0 AS has_gap FROM p""",
)
def window_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth windows with the composition of the reference at the same place."""
    docs = bind.table(spark, sf_dir, "documents")
    chunks = F.regexp_extract_all("text", F.lit("(?s).{1,100}"), F.lit(0))
    pieces = docs.select(F.col("doc_id").alias("contig"), F.posexplode(chunks).alias("window_id", "piece"))
    last = F.expr("(length(text) - 1) div 100")
    windows = docs.filter(F.length("text") > 0).select(
        F.col("doc_id").alias("contig"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("window_id"), F.col("n_chars").alias("cov")
    )
    joined = dp.with_composition(windows, dp.composition(pieces, ["contig", "window_id"], "piece"))
    return joined.select("contig", "window_id", "cov", F.round(F.col("gc").cast("double"), 4).alias("gc"), "has_gap")


@register(
    "contig_medians",
    """SELECT name, ROUND(quantile_cont(value, 0.5), 6) AS median FROM (
         SELECT event_type AS name, value FROM events
         UNION ALL SELECT 'autosomes', value FROM events WHERE event_type IN ('click', 'view')) GROUP BY name""",
)
def contig_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians per contig and over a set of contigs."""
    windows = bind.table(spark, sf_dir, "events").select(F.col("event_type").alias("contig"), F.col("value").alias("cov"))
    kinds = ["click", "view"]
    return dp.depth_medians(windows, kinds, ["error", "purchase", "signup", "login", "scroll", "logout"]).select(
        "name", F.round("median", 6).alias("median")
    )


def _norm_depth_sql(end: str) -> str:
    return with_cte(
        f""", c AS (SELECT row_id, chrom, pos AS lo, {end} AS hi FROM svs WHERE sv_type IN ('DEL', 'DUP', 'CNV')),
          j AS (SELECT row_id, cov, mapq, SUM(CASE WHEN mapq >= 55 THEN 1 ELSE 0 END) OVER (PARTITION BY row_id) AS good
            FROM c JOIN depth d ON d.contig = c.chrom AND d.start < c.hi AND c.lo < d.stop)
          SELECT row_id, ROUND(quantile_cont(cov, 0.5) / (SELECT quantile_cont(cov, 0.5) FROM depth WHERE contig IN ('F', 'O')), 6) AS norm_cov
          FROM j WHERE good < {MIN_BINS} OR mapq >= 55 GROUP BY row_id""",
        "svs",
        "depth",
    ).replace(") , c AS", "), c AS")


def _norm_depth(spark: SparkSession, sf_dir: str, svs: DataFrame, reach: int) -> DataFrame:
    windows = bind.depth(spark, sf_dir)
    median = exact_quantiles(windows.filter(F.col("contig").isin("F", "O")), [], "cov", {"m": 0.5}).scalar()
    ratio = an.depth_ratio(svs, windows, median, None, MIN_BINS, reach)
    return ratio.select("row_id", F.round("norm_cov", 6).alias("norm_cov"))


@register("norm_depth", _norm_depth_sql("end2"))
def norm_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median depth inside copy-number variants, relative to the autosomes."""
    return _norm_depth(spark, sf_dir, bind.svs(spark, sf_dir), an.REACH)


@register("norm_depth_long", _norm_depth_sql("pos + sv_len * sv_len"))
def norm_depth_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for variants of thousands of windows, most of which are too long for blocks of the first level."""
    svs = bind.svs(spark, sf_dir).withColumn("end2", F.col("pos") + F.col("sv_len") * F.col("sv_len"))
    return _norm_depth(spark, sf_dir, svs, 1 << 15)


@register(
    "centre_crop",
    with_cte(
        f""" SELECT row_id, pos + CASE WHEN sv_len > {CROP} THEN (sv_len - {CROP}) // 2 ELSE 0 END AS lo,
            end2 - CASE WHEN sv_len > {CROP} THEN (sv_len - {CROP}) // 2 ELSE 0 END AS hi FROM svs""",
        "svs",
    ),
)
def centre_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals cut to their middle, as the compatible mode does with long variants."""
    lo, hi = iv.centre_crop(F.col("pos"), F.col("end2"), CROP)
    return bind.svs(spark, sf_dir).select("row_id", lo.alias("lo"), hi.alias("hi"))


_HET = "length(alt) = 1 AND gt IN ('0/1', './1')"
_CNV_SQL = (
    f", c AS (SELECT row_id, chrom, sv_type, sv_len, pos AS lo, end2 AS hi FROM svs WHERE sv_type IN ('DEL', 'DUP', 'CNV')), "
    f"h AS (SELECT * FROM snvs WHERE {_HET})"
)
_COUNTS_SQL = """, k AS (SELECT row_id, sv_type, sv_len,
   (SELECT COUNT(*) FROM h WHERE contig = chrom AND h.pos >= greatest(lo - (hi - lo), 0) AND h.pos < lo) AS snvs_left,
   (SELECT COUNT(*) FROM h WHERE contig = chrom AND h.pos >= lo AND h.pos < hi) AS snvs_within,
   (SELECT COUNT(*) FROM h WHERE contig = chrom AND h.pos >= hi AND h.pos < hi + (hi - lo)) AS snvs_right FROM c)"""


def _with_snvs(sql: str) -> str:
    return with_cte(_CNV_SQL + sql, "svs", "snvs").replace(") , c AS", "), c AS")


@register("snv_flank_counts", _with_snvs(_COUNTS_SQL + " SELECT row_id, snvs_left, snvs_within, snvs_right FROM k"))
def snv_flank_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heterozygous variants within and beside copy-number variants."""
    snvs = an.het_snvs(bind.variants(spark, sf_dir))
    return an.snv_counts(bind.svs(spark, sf_dir), snvs, None)


@register(
    "roh_flag",
    _with_snvs(
        _COUNTS_SQL
        + """, f AS (SELECT *, CASE WHEN sv_len * 100 >= 100000 THEN 50 ELSE 5 * (sv_len * 100 // 10000) END AS least FROM k)
        SELECT row_id, CASE WHEN sv_type = 'DEL' THEN snvs_left END AS vl, CASE WHEN sv_type = 'DEL' THEN snvs_within END AS vm,
          CASE WHEN sv_type = 'DEL' THEN snvs_right END AS vr, (snvs_right < least OR snvs_left < least) AND snvs_within < least AS roh FROM f"""
    ),
)
def roh_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of homozygosity by variant counts against a length-dependent minimum."""
    svs = bind.svs(spark, sf_dir)
    counts = an.snv_counts(svs, an.het_snvs(bind.variants(spark, sf_dir)), None)
    lengths = svs.select("row_id", "sv_type", (F.col("sv_len") * 100).alias("sv_len"))
    deletion = F.col("sv_type") == "DEL"
    return counts.join(lengths, "row_id").select(
        "row_id",
        F.when(deletion, F.col("snvs_left")).alias("vl"),
        F.when(deletion, F.col("snvs_within")).alias("vm"),
        F.when(deletion, F.col("snvs_right")).alias("vr"),
        an.homozygosity_run(F.col("sv_len"), F.col("snvs_left"), F.col("snvs_within"), F.col("snvs_right")).alias("roh"),
    )


def _baf_list_sql(end: str) -> str:
    text = _with_snvs(
        """ SELECT row_id, COALESCE(string_agg(CASE WHEN h.pos IS NULL THEN NULL WHEN a0 + a1 > 0 THEN printf('%.5f', CAST(a1 AS DOUBLE) / (a0 + a1)) ELSE 'NaN' END, ';' ORDER BY h.pos, ord), '') AS bafs
        FROM c LEFT JOIN h ON contig = chrom AND h.pos >= lo AND h.pos < hi WHERE c.sv_type IN ('DUP', 'CNV') GROUP BY row_id"""
    )
    return text.replace("end2 AS hi", f"{end} AS hi")


@register("baf_list", _baf_list_sql("end2"))
def baf_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allele fractions inside duplications and CNVs."""
    snvs = an.het_snvs(bind.variants(spark, sf_dir), ("ord",))
    return an.baf_lists(bind.svs(spark, sf_dir), snvs, ["ord"], None)


@register("baf_list_long", _baf_list_sql("pos + sv_len * sv_len"))
def baf_list_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for long variants that lie within each other."""
    snvs = an.het_snvs(bind.variants(spark, sf_dir), ("ord",))
    svs = bind.svs(spark, sf_dir).withColumn("end2", F.col("pos") + F.col("sv_len") * F.col("sv_len"))
    return an.baf_lists(svs, snvs, ["ord"], None)


# --- statistics ------------------------------------------------------------------------------


def _insert_size_sql(limit: str) -> str:
    return with_cte(
        f""", s AS (SELECT CAST(tlen AS DOUBLE) AS t FROM reads WHERE (flag & 3) = 3 AND (flag & 3852) = 0 AND tlen > 0 AND tid = mtid
             {limit}),
           m AS (SELECT list_sort(list(t))[CAST(COUNT(*) // 2 + 1 AS BIGINT)] AS med FROM s),
           v AS (SELECT MAX(med) AS median_isize, sqrt(AVG((t - med) * (t - med))) AS sd FROM s, m
             WHERE t >= greatest(med - 0.1 * 7.0 * med, 0) AND t <= med + 0.1 * 7.0 * med)
           SELECT CAST(150 AS BIGINT) AS max_rlen, median_isize, ROUND(sd, 4) AS std_dev_isize,
             CAST(ceil(median_isize + 3.0 * sd) AS BIGINT) AS max_normal_isize FROM v""",
        "reads",
    ).replace(") , s AS", "), s AS")


@register("insert_size_model", _insert_size_sql(""))
def insert_size_model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-size model from all clean pairs."""
    sizes = bind.reads(spark, sf_dir).filter(rd.library_sample()).select("tlen")
    return insert_size_model(sizes, CONFIG).withColumn("std_dev_isize", F.round("std_dev_isize", 4))


@register("insert_size_first_pairs", _insert_size_sql(f"ORDER BY ord, tlen LIMIT {CONFIG.lib_estimation_sample_size + 1}"))
def insert_size_first_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-size model from the first clean pairs, as the compatible mode has it."""
    sampled = first_pairs(bind.reads(spark, sf_dir), ["ord", "tlen"], sample_size(CONFIG))
    model = insert_size_model(sampled, CONFIG)
    return model.withColumn("std_dev_isize", F.round("std_dev_isize", 4))


_MAD_SQL = """med AS (SELECT event_type, quantile_cont(value, 0.5) AS m FROM events GROUP BY 1),
  mad AS (SELECT e.event_type, quantile_cont(abs(value - m), 0.5) * 1.4826 AS mad FROM events e JOIN med USING (event_type) GROUP BY 1)"""


@register(
    "stats_summary",
    f"""WITH {_MAD_SQL}
    SELECT event_type, ROUND(SUM(value), 4) AS sum, MIN(value) AS min, MAX(value) AS max, ROUND(AVG(value), 6) AS mean,
      ROUND(MAX(m), 6) AS median, ROUND(COALESCE(var_samp(value), 0), 4) AS var, ROUND(COALESCE(stddev_samp(value), 0), 6) AS std_dev,
      ROUND(COALESCE(stddev_samp(value), 0) / AVG(value) * 100, 4) AS std_dev_pct, ROUND(MAX(mad), 6) AS median_abs_dev,
      ROUND(MAX(mad) / MAX(m) * 100, 4) AS median_abs_dev_pct, ROUND(quantile_cont(value, 0.25), 6) AS q1,
      ROUND(quantile_cont(value, 0.75), 6) AS q3, ROUND(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr
    FROM events JOIN med USING (event_type) JOIN mad USING (event_type) GROUP BY event_type""",
)
def stats_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All descriptive statistics per group."""
    out = summary(bind.table(spark, sf_dir, "events").select("event_type", "value"), ["event_type"], "value")
    rounded = {"sum": 4, "mean": 6, "median": 6, "var": 4, "std_dev": 6, "std_dev_pct": 4, "median_abs_dev": 6, "median_abs_dev_pct": 4, "iqr": 6}
    return out.select(
        "event_type", "min", "max",
        *[F.round(c, d).alias(c) for c, d in rounded.items()],
        F.round("quartiles.q1", 6).alias("q1"),
        F.round("quartiles.q3", 6).alias("q3"),
    )


@register(
    "winsorize",
    """WITH lim AS (SELECT event_type, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM events GROUP BY 1)
    SELECT event_id, event_type, ROUND(greatest(least(value, hi), lo), 6) AS value FROM events JOIN lim USING (event_type)""",
)
def winsorize_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values pulled in to percentiles of their group."""
    rows = bind.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return winsorize(rows, ["event_type"], "value", 5.0).select("event_id", "event_type", F.round("value", 6).alias("value"))


@register(
    "median_abs_dev",
    f"""WITH {_MAD_SQL} SELECT event_type, ROUND(m, 6) AS median, ROUND(mad, 6) AS median_abs_dev, ROUND(mad / m * 100, 4) AS median_abs_dev_pct
    FROM med JOIN mad USING (event_type)""",
)
def median_abs_dev_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled median absolute deviation."""
    out = median_abs_dev(bind.table(spark, sf_dir, "events").select("event_type", "value"), ["event_type"], "value")
    return out.select(
        "event_type", F.round("median", 6).alias("median"), F.round("median_abs_dev", 6).alias("median_abs_dev"),
        F.round("median_abs_dev_pct", 4).alias("median_abs_dev_pct"),
    )


# --- joins and sets --------------------------------------------------------------------------


@register(
    "multi_join",
    """WITH a AS (SELECT o_orderkey AS key, o_custkey AS a FROM orders), b AS (SELECT l_orderkey AS key, l_linenumber AS b, l_suppkey AS s FROM lineitem),
      c AS (SELECT event_id AS key, event_type AS c FROM events), d AS (SELECT p_partkey AS key, p_brand AS d FROM part)
    SELECT key, a, b, s, c, d FROM a JOIN b USING (key) JOIN c USING (key) JOIN d USING (key)""",
)
def multi_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner join of any number of tables on their first column."""
    from riftspan.sources.multijoin import multijoin

    orders = bind.table(spark, sf_dir, "orders").selectExpr("o_orderkey AS key", "o_custkey AS a")
    lines = bind.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS key", "l_linenumber AS b", "l_suppkey AS s")
    events = bind.table(spark, sf_dir, "events").selectExpr("event_id AS key", "event_type AS c")
    parts = bind.table(spark, sf_dir, "part").selectExpr("p_partkey AS key", "p_brand AS d")
    return multijoin([orders, lines, events, parts], "key")


@register(
    "union_all_sources",
    """SELECT 0 AS file_ord, o_orderkey AS id, o_orderstatus AS chrom FROM orders
    UNION ALL SELECT 1, l_orderkey, l_returnflag FROM lineitem UNION ALL SELECT 2, event_id, event_type FROM events""",
)
def union_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of several inputs one after another, marked with their input."""
    from riftspan.sources.multijoin import stack_inputs

    return stack_inputs(
        [
            bind.table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_orderstatus AS chrom"),
            bind.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS id", "l_returnflag AS chrom"),
            bind.table(spark, sf_dir, "events").selectExpr("event_id AS id", "event_type AS chrom"),
        ]
    )


@register(
    "id_intersection",
    with_cte(
        f"SELECT qname FROM reads WHERE {_SPLIT_LEFT} INTERSECT SELECT qname FROM reads WHERE {_SPLIT_RIGHT}", "reads"
    ),
)
def id_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates clipped at the left in one row and at the right in one row."""
    rows = bind.reads(spark, sf_dir)
    sides = rows.groupBy("qname").agg(
        F.max(rd.split_left(MIN_CLIP)).alias("left"), F.max(rd.split_right(MIN_CLIP)).alias("right")
    )
    return sides.filter("left AND right").select("qname")


@register(
    "distinct_samples",
    with_cte("SELECT sample, MIN(row_id) AS first_seen FROM svs GROUP BY sample", "svs"),
)
def distinct_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples by first appearance."""
    return bind.svs(spark, sf_dir).groupBy("sample").agg(F.min("row_id").alias("first_seen"))


@register(
    "annotated_variants",
    _with_evidence(
        f""", {_windows_sql()}, hits AS (
          SELECT DISTINCT w.row_id, w.pair, w.side, e.kind, e.read_id, e.kind = 'SplitRead' AND e.is_first AS mate
          FROM windows w JOIN evidence e ON e.contig = w.contig AND e."start" < w.hi AND w.lo < e."end"
            AND CASE WHEN e.kind = 'PairedRead' THEN e.strand1 = w.strand ELSE e.clipped_sides = 'Both'
              OR (e.clipped_sides = 'Right' AND w.strand = 'Forward') OR (e.clipped_sides = 'Left' AND w.strand = 'Reverse') END),
        paired AS (SELECT row_id, kind, pair, read_id, mate FROM hits GROUP BY ALL HAVING COUNT(DISTINCT side) = 2),
        n AS (SELECT row_id, SUM(CASE WHEN kind = 'PairedRead' THEN 1 ELSE 0 END) AS pe, SUM(CASE WHEN kind = 'SplitRead' THEN 1 ELSE 0 END) AS sr
          FROM paired GROUP BY row_id)"""
        + _CNV_SQL
        + _COUNTS_SQL
        + """ SELECT s.row_id, CAST(COALESCE(pe, 0) AS DOUBLE) AS pr, CAST(COALESCE(sr, 0) AS DOUBLE) AS sr, CASE WHEN s.sv_type = 'DEL' THEN snvs_within END AS vm
        FROM svs s LEFT JOIN n ON n.row_id = s.row_id LEFT JOIN k ON k.row_id = s.row_id""",
        "reads",
        "svs",
        "snvs",
    ).replace(") , windows", "), windows"),
)
def annotated_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants with read and small-variant evidence side by side."""
    config = replace(CONFIG, annotate_read_evidence_max_dist=MAX_DIST, annotate_read_evidence_slack=SLACK)
    out = an.annotate(
        bind.svs(spark, sf_dir), config, evidence=_evidence(spark, sf_dir), snvs=an.het_snvs(bind.variants(spark, sf_dir))
    )
    return out.select("row_id", F.col("PR").cast("double").alias("pr"), F.col("SR").cast("double").alias("sr"), F.col("VM").alias("vm"))



@register(
    "annotation_row",
    with_cte(
        _CNV_SQL
        + _COUNTS_SQL
        + f""", j AS (SELECT row_id, cov, mapq, SUM(CASE WHEN mapq >= 55 THEN 1 ELSE 0 END) OVER (PARTITION BY row_id) AS good
            FROM c JOIN depth d ON d.contig = c.chrom AND d.start < c.hi AND c.lo < d.stop),
          r AS (SELECT row_id, quantile_cont(cov, 0.5) / (SELECT quantile_cont(cov, 0.5) FROM depth WHERE contig IN ('F', 'O')) AS rd
            FROM j WHERE good < {CONFIG.doc_annotation_min_bins} OR mapq >= 55 GROUP BY row_id)
          SELECT s.row_id, ROUND(rd, 3) AS rd, CASE WHEN s.sv_type = 'DEL' THEN snvs_left END AS vl, CASE WHEN s.sv_type = 'DEL' THEN snvs_within END AS vm,
            CASE WHEN s.sv_type = 'DEL' THEN snvs_right END AS vr,
            CASE WHEN (snvs_right < least OR snvs_left < least) AND snvs_within < least THEN 1 END AS roh
          FROM (SELECT *, CASE WHEN sv_len >= 100 THEN 50 ELSE 5 * (sv_len * 1000 // 10000) END AS least FROM svs) s LEFT JOIN k ON k.row_id = s.row_id LEFT JOIN r ON r.row_id = s.row_id""",
        "svs",
        "snvs",
        "depth",
    ).replace(") , c AS", "), c AS"),
)
def annotation_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth ratio, small-variant counts and homozygosity of every variant, as they are written."""
    windows = bind.depth(spark, sf_dir)
    median = exact_quantiles(windows.filter(F.col("contig").isin("F", "O")), [], "cov", {"m": 0.5}).scalar()
    svs = bind.svs(spark, sf_dir).withColumn("sv_len", F.col("sv_len") * 1_000)  # long enough for runs of homozygosity
    out = an.annotate(svs, CONFIG, windows=windows, autosome_median=median, snvs=an.het_snvs(bind.variants(spark, sf_dir)))
    return out.select(
        "row_id", F.round(F.col("RD").cast("double"), 3).alias("rd"), F.col("VL").alias("vl"), F.col("VM").alias("vm"), F.col("VR").alias("vr"), F.col("ROH").alias("roh")
    )
