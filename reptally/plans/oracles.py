"""DuckDB SQL with the same results as the queries.

Named building blocks are kept in ``BLOCKS``; a statement gets those it mentions,
directly or through others, as common table expressions.
"""

from __future__ import annotations

import re

from reptally.functions.numeric import normal_quantile

BLOCKS: dict[str, str] = {}


def block(name: str, sql: str) -> None:
    BLOCKS[name] = sql


def _mentioned(sql: str) -> set[str]:
    return {w for w in re.findall(r"[a-z_][a-z_0-9]*", sql) if w in BLOCKS}


def with_blocks(sql: str) -> str:
    needed: set[str] = set()
    todo = _mentioned(sql)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= _mentioned(BLOCKS[name])
    parts = [f"{n} AS ({BLOCKS[n]})" for n in BLOCKS if n in needed]
    return f"WITH RECURSIVE {', '.join(parts)} {sql}" if parts else sql


def rounded(columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns.split())


# the tables seen as counts and a sheet

block(
    "counts",
    """SELECT l_linestatus AS run, 's' || l_suppkey AS sample,
       CASE WHEN l_returnflag IN ('A', 'N') THEN 'merged' WHEN l_linenumber % 3 = 0 THEN 'forward'
            WHEN l_linenumber % 3 = 1 THEN 'reverse' ELSE 'unmerged' END
         || '_' || l_linestatus || '_' || l_partkey AS feature,
       p_brand || ';' || p_type AS taxon, CAST(sum(l_quantity) AS BIGINT) AS reads
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
)
block(
    "sheet",
    """SELECT 'lib.' || s_suppkey || '.S1' AS raw_name, 's' || s_suppkey AS sample, site, bio_rep,
       CAST(row_number() OVER (PARTITION BY site, bio_rep, sample_control ORDER BY s_suppkey) AS VARCHAR) AS tech_rep,
       sample_control, control_type
       FROM (SELECT s_suppkey, r_name || '_' || (s_suppkey // 100) AS site,
             CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS bio_rep,
             CASE s_suppkey % 10 WHEN 0 THEN 'Pos' WHEN 5 THEN 'Blank' END AS control_type,
             CASE WHEN s_suppkey % 10 IN (0, 5) THEN 'Control' ELSE 'Sample' END AS sample_control
             FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
)
block("merged", "SELECT * FROM counts WHERE feature LIKE '%merged%' AND feature NOT LIKE '%unmerged%'")
block(
    "labelled",
    """SELECT m.*, coalesce(site, 'NA') AS site, coalesce(bio_rep, 'NA') AS bio_rep, coalesce(tech_rep, 'NA') AS tech_rep,
       CASE control_type WHEN 'Pos' THEN 'Positives' WHEN 'Blank' THEN 'Blanks' ELSE 'Samples' END AS source
       FROM merged m LEFT JOIN sheet USING (sample)""",
)
for _name, _source in (("samples", "Samples"), ("blanks", "Blanks"), ("positives", "Positives")):
    block(_name, f"SELECT * EXCLUDE (source) FROM labelled WHERE source = '{_source}'")

# step 1


def vector_sql(positives: str) -> str:
    return f"""SELECT run, feature, max(reads / total) AS v
        FROM (SELECT *, CAST(sum(reads) OVER (PARTITION BY run, sample) AS BIGINT) AS total FROM {positives})
        GROUP BY run, feature"""


def subtract_sql(rows: str, vector: str) -> str:
    return f"""SELECT * EXCLUDE (total, v, reads, left_over), left_over AS reads FROM (
        SELECT s.*, v, reads - CASE WHEN v IS NULL THEN 0 ELSE CAST(ceil(v * total) AS BIGINT) END AS left_over
        FROM (SELECT *, CAST(sum(reads) OVER (PARTITION BY run, sample) AS BIGINT) AS total FROM {rows}) s
        LEFT JOIN {vector} USING (run, feature)) WHERE left_over > 0"""


def bin_sql(x: str, low: str, width: str) -> str:
    return f"CAST(coalesce(ceil(({x} - {low}) / nullif({width}, 0) - 0.5), 0) AS BIGINT)"


block("vector", vector_sql("positives"))
block("step1", subtract_sql("samples", "vector"))

# step 2


def depth_sql(rows: str) -> str:
    return f"SELECT run, sample, CAST(sum(reads) AS BIGINT) AS tot FROM {rows} GROUP BY run, sample"


def _digamma(x: str) -> str:
    y = f"({x} + 10)"
    small = " - ".join(f"1 / ({x} + {i})" for i in range(10))
    return (
        f"(ln{y} - 0.5 / {y} - 1 / (12 * {y} ** 2) + 1 / (120 * {y} ** 4) - 1 / (252 * {y} ** 6)"
        f" + 1 / (240 * {y} ** 8) - {small})"
    )


def _trigamma(x: str) -> str:
    y = f"({x} + 10)"
    small = " + ".join(f"1 / ({x} + {i}) ** 2" for i in range(10))
    return (
        f"(1 / {y} + 0.5 / {y} ** 2 + 1 / (6 * {y} ** 3) - 1 / (30 * {y} ** 5) + 1 / (42 * {y} ** 7)"
        f" - 1 / (30 * {y} ** 9) + {small})"
    )


def gamma_blocks(prefix: str, depth: str) -> None:
    """Blocks for the fit (Newton's method) and for probabilities (power series)."""
    block(
        f"{prefix}stats",
        f"""SELECT count(tot) AS n, avg(tot) AS mean, ln(avg(tot)) - avg(ln(CAST(tot AS DOUBLE))) AS gap
            FROM {depth}""",
    )
    block(
        f"{prefix}newton",
        f"""SELECT 0 AS i, (3 - gap + sqrt((gap - 3) ** 2 + 24 * gap)) / (12 * gap) AS s FROM {prefix}stats
            UNION ALL
            SELECT i + 1, s - (ln(s) - {_digamma('s')} - gap) / (1 / s - {_trigamma('s')})
            FROM {prefix}newton, {prefix}stats WHERE i < 25""",
    )
    block(
        f"{prefix}fit",
        f"SELECT mean / s AS scale, s AS shape, n FROM {prefix}newton, {prefix}stats WHERE i = 25",
    )
    block(
        f"{prefix}prob",
        f"""SELECT run, sample, any_value(tot) AS tot, sum(exp(-tot / scale + (shape + j) * ln(tot / scale)
                - lgamma(shape + j + 1))) AS prob
            FROM {depth}, {prefix}fit, (SELECT unnest(range(3000)) AS j) GROUP BY run, sample""",
    )


block("depth", depth_sql("samples"))
gamma_blocks("g_", "depth")
block("bad", "SELECT run, sample, tot FROM g_prob WHERE prob < 0.3 OR tot < (SELECT avg(tot) * 0.95 FROM depth)")

# step 3


def mean_blank_sql(blanks: str) -> str:
    return f"""SELECT run, feature, CAST(sum(reads) AS BIGINT) / any_value(n_blanks) AS b FROM {blanks}
        JOIN (SELECT run, count(DISTINCT sample) AS n_blanks FROM {blanks} GROUP BY run) USING (run)
        GROUP BY run, feature"""


def round_sql(rows: str, profile: str, rank: int) -> str:
    return f"""SELECT * REPLACE (reads - coalesce(CAST(floor(scale * b + 0.5) AS BIGINT), 0) AS reads) FROM (
        SELECT * EXCLUDE (ratio, nth), max(CASE WHEN nth = {rank} THEN ratio END) OVER (PARTITION BY run, sample) AS scale
        FROM (SELECT *, row_number() OVER (PARTITION BY run, sample ORDER BY ratio NULLS LAST, feature) AS nth
              FROM (SELECT s.*, b, reads / b AS ratio FROM {rows} s LEFT JOIN {profile} USING (run, feature))))"""


def clean_round_sql(rows: str, profile: str, rank: int = 1) -> str:
    return f"SELECT * EXCLUDE (b, scale) FROM ({round_sql(rows, profile, rank)}) WHERE reads > 0"


def sizes_sql(rows: str, group: str = "site, bio_rep") -> str:
    return f"SELECT run, {group}, count(DISTINCT sample) AS n_samples FROM {rows} GROUP BY run, {group}"


def zero_filter_sql(rows: str, blanks: str, sizes: str, thresh: float, group: str = "site, bio_rep") -> str:
    return f"""SELECT * FROM {rows} ANTI JOIN (
        SELECT run, {group}, feature FROM
          (SELECT run, {group}, feature, count(*) AS n FROM {rows}
           SEMI JOIN {blanks} USING (run, feature) GROUP BY ALL)
        JOIN {sizes} USING (run, {group})
        WHERE n_samples - n >= n_samples * CAST({thresh} AS DOUBLE)) USING (run, {group}, feature)"""


def prop_filter_sql(rows: str, blanks: str, thresh: float, group: str = "site, bio_rep") -> str:
    return f"""SELECT * FROM {rows} ANTI JOIN (
        SELECT run, {group}, feature FROM (
          SELECT run, {group}, feature, sum(reads) AS part, sum(sum(reads)) OVER (PARTITION BY run, {group}) AS whole
          FROM {rows} GROUP BY run, {group}, feature)
        SEMI JOIN {blanks} USING (run, feature)
        WHERE part < whole * CAST({thresh} AS DOUBLE)) USING (run, {group}, feature)"""


block("profile", mean_blank_sql("blanks"))
block("round1", clean_round_sql("samples", "profile"))
block("round2", clean_round_sql("round1", "profile"))
block("third1", clean_round_sql("samples", "profile", 3))
block("third2", clean_round_sql("third1", "profile", 3))
block("sizes", sizes_sql("samples"))

# step 4

GRID = 80


def found_sql(rows: str, mode: str = "double") -> str:
    level = "bio_rep, tech_rep" if mode == "double" else "bio_rep"
    return f"SELECT DISTINCT feature, taxon, site, {level} FROM {rows}"


def _nodes_sql(a: str, b: str) -> str:
    """Log-odds of a Beta(a, b) rate, evenly spaced; every fall-off is below 1e-8 at the ends."""
    low = f"(ln({a} / {b}) - 18 / {a} - 5 * sqrt(1 / {a} + 1 / {b}))"
    high = f"(ln({a} / {b}) + 18 / {b} + 5 * sqrt(1 / {a} + 1 / {b}))"
    return f"({low} + ({high} - {low}) * ((i + 0.5) / {GRID}))"


def occupancy_blocks(prefix: str, found: str, mode: str = "double") -> None:
    p = prefix
    level = "tech_rep" if mode == "double" else "bio_rep"
    block(f"{p}k", f"SELECT site, count(DISTINCT {level}) AS k FROM {found} GROUP BY site")
    block(f"{p}cells", f"SELECT feature, taxon, site, bio_rep, count(*) AS n_det FROM {found} GROUP BY ALL")
    block(
        f"{p}patterns",
        f"""SELECT feature, taxon, site, string_agg(bio_rep || '=' || n_det, '.' ORDER BY bio_rep || '=' || n_det) AS pattern,
            CAST(sum(n_det) AS BIGINT) AS detections, max(n_det) AS max_detections, any_value(k) AS k
            FROM {p}cells JOIN {p}k USING (site)
            GROUP BY feature, taxon, site""",
    )
    block(
        f"{p}unique",
        f"""SELECT pattern, n_rows, feature, site, k, detections, max_detections FROM (
            SELECT *, count(*) OVER (PARTITION BY k, pattern) AS n_rows,
            row_number() OVER (PARTITION BY k, pattern ORDER BY feature, site) AS nth FROM {p}patterns) WHERE nth = 1""",
    )
    if mode == "double":
        rows = f"""SELECT feature, site, bio_rep, k, n_det AS n FROM {p}cells
            JOIN (SELECT feature, site, k FROM {p}unique) USING (feature, site)"""
    else:
        rows = f"SELECT feature, site, 'all' AS bio_rep, k, detections AS n FROM {p}unique"
    block(f"{p}rows", rows)
    block(
        f"{p}fit",
        f"""SELECT feature, site, bio_rep, k, n,
            CAST(sum(z) OVER at_place + 2 AS BIGINT) AS a_psi, CAST(sum(1 - z) OVER at_place + 2 AS BIGINT) AS b_psi,
            CAST(sum(z * n) OVER of_kind + 2 AS BIGINT) AS a_p11,
            CAST(sum(z * (k - n)) OVER of_kind + 2 AS BIGINT) AS b_p11,
            CAST(sum((1 - z) * n) OVER of_kind + 1 AS BIGINT) AS a_p10,
            CAST(sum((1 - z) * (k - n)) OVER of_kind + 10 AS BIGINT) AS b_p10
            FROM (SELECT *, CASE WHEN n > 0 THEN 1 ELSE 0 END AS z FROM {p}rows)
            WINDOW at_place AS (PARTITION BY feature, site), of_kind AS (PARTITION BY feature)""",
    )
    sets = "k, n, a_psi, b_psi, a_p11, b_p11, a_p10, b_p10"
    block(f"{p}sets", f"SELECT DISTINCT {sets} FROM {p}fit")

    def side(a: str, b: str, value: str) -> str:
        y = _nodes_sql(f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)")
        return f"""SELECT {sets}, exp(lw - max(lw) OVER (PARTITION BY {sets})) AS w, {value} AS e FROM (
            SELECT {sets}, lx, lr, {a} * lx + {b} * lr AS lw FROM (
              SELECT {sets}, -ln(1 + exp(-y)) AS lx, -ln(1 + exp(y)) AS lr FROM (
                SELECT {sets}, {y} AS y FROM {p}sets, (SELECT unnest(range({GRID})) AS i))))"""

    likelihood = "n * lx + (k - n) * lr"
    block(f"{p}psi", side("a_psi", "b_psi", "lr - lx"))
    block(f"{p}p11", side("a_p11", "b_p11", likelihood))
    block(f"{p}p10", side("a_p10", "b_p10", likelihood))
    block(
        f"{p}means",
        f"""SELECT {sets}, sum(w * r) / sum(w) AS mean, sum(w * r * r) / sum(w) AS square FROM (
            SELECT {sets}, s.w * d.w * f.w AS w, 1 / (1 + exp(s.e - d.e + f.e)) AS r
            FROM {p}psi s JOIN {p}p11 d USING ({sets}) JOIN {p}p10 f USING ({sets})) GROUP BY {sets}""",
    )
    block(
        f"{p}probs",
        f"""SELECT feature, site, bio_rep, {sets}, mean, sqrt(greatest(0, square - mean * mean)) AS sd
            FROM {p}fit JOIN {p}means USING ({sets})""",
    )
    block(f"{p}best", f"SELECT feature, site, max(mean) AS occupancy FROM {p}probs GROUP BY feature, site")
    block(f"{p}scored", f"SELECT u.*, occupancy FROM {p}unique u LEFT JOIN {p}best USING (feature, site)")
    block(
        f"{p}results",
        f"""SELECT p.*, occupancy FROM {p}patterns p
            LEFT JOIN (SELECT k, pattern, occupancy FROM {p}scored) USING (k, pattern)""",
    )
    second = "max_detections = 1" if mode == "double" else "detections = 2"
    block(
        f"{p}cutoffs",
        f"""SELECT max(occupancy) FILTER (WHERE detections = 1) AS som_min_threshold_1,
            max(occupancy) FILTER (WHERE {second}) AS som_min_threshold_2,
            min(occupancy) FILTER (WHERE detections = 3) AS som_min_threshold_3 FROM {p}scored""",
    )


block("found", found_sql("samples"))
block("found_single", found_sql("samples", "single"))
occupancy_blocks("o_", "found")
occupancy_blocks("os_", "found_single", "single")

# step 5


def index_sql(rows: str) -> str:
    return f"""SELECT *, share / max(share) OVER (PARTITION BY feature) AS index FROM (
        SELECT *, reads / CAST(sum(reads) OVER (PARTITION BY sample) AS BIGINT) AS share FROM {rows})"""


def values_sql(rows: str, grp: str, unit: str, item: str) -> str:
    return f"""SELECT {grp} AS grp, {unit} AS unit, {item} AS item, sum(index) AS value FROM {rows}
        GROUP BY ALL HAVING sum(index) > 0"""


def pairs_sql(values: str) -> str:
    return f"""SELECT grp, a, b, greatest(0, 1 - 2 * shared / (ta.total + tb.total)) AS dist FROM (
        SELECT x.grp, x.unit AS a, y.unit AS b, sum(least(x.value, y.value)) AS shared
        FROM {values} x JOIN {values} y ON x.grp = y.grp AND x.item = y.item AND x.unit < y.unit GROUP BY ALL)
        JOIN (SELECT grp, unit AS a, sum(value) AS total FROM {values} GROUP BY ALL) ta USING (grp, a)
        JOIN (SELECT grp, unit AS b, sum(value) AS total FROM {values} GROUP BY ALL) tb USING (grp, b)"""


def all_pairs_sql(values: str, pairs: str) -> str:
    """Pairs that share nothing too, at distance 1."""
    return f"""SELECT u.grp, u.unit AS a, w.unit AS b, round(coalesce(dist, 1), 6) AS dist
        FROM (SELECT DISTINCT grp, unit FROM {values}) u JOIN (SELECT DISTINCT grp, unit FROM {values}) w ON u.grp = w.grp AND u.unit < w.unit
        LEFT JOIN {pairs} p ON p.grp = u.grp AND p.a = u.unit AND p.b = w.unit"""


def centres_sql(values: str, pairs: str) -> str:
    return f"""SELECT grp, unit, sqrt(abs(avg(dd) OVER (PARTITION BY grp, unit)
          - 0.5 * avg(dd) OVER (PARTITION BY grp))) AS distance FROM (
        SELECT u.grp, u.unit, CASE WHEN u.unit = w.unit THEN 0 ELSE coalesce(dist, 1) ** 2 END AS dd
        FROM (SELECT DISTINCT grp, unit FROM {values}) u JOIN (SELECT DISTINCT grp, unit FROM {values}) w USING (grp)
        LEFT JOIN {pairs} p ON p.grp = u.grp AND p.a = least(u.unit, w.unit) AND p.b = greatest(u.unit, w.unit))
        QUALIFY row_number() OVER (PARTITION BY grp, unit) = 1 AND count(*) OVER (PARTITION BY grp) > 1"""


def outliers_sql(centres: str, prob: float) -> str:
    return f"""SELECT grp, unit, distance FROM {centres} WHERE distance >
        (SELECT avg(distance) + {normal_quantile(prob)!r} * stddev_pop(distance) FROM {centres})"""


GROUP = "run || ':' || site || ':' || bio_rep"
UNIT = f"{GROUP} || ':' || tech_rep"

block("indexed", index_sql("samples"))
block("all_values", values_sql("indexed", "''", "run || ':' || sample", "feature"))
block("all_pairs", pairs_sql("all_values"))
block("in_values", values_sql("indexed", GROUP, UNIT, "taxon"))
block("in_pairs", pairs_sql("in_values"))
block("single_values", values_sql("indexed", "run || ':' || site", GROUP, "taxon"))
block("single_pairs", pairs_sql("single_values"))
block("units", "SELECT DISTINCT run || ':' || sample AS unit, run, site, bio_rep FROM samples")
CLASS_ORDER = """CASE WHEN x.run = y.run AND x.site = y.site AND x.bio_rep = y.bio_rep THEN 0
    WHEN x.run = y.run AND x.site = y.site THEN 1 WHEN x.run = y.run THEN 2 ELSE 3 END"""
CLASS_NAME = """CASE class_order WHEN 0 THEN 'PCR.replicates' WHEN 1 THEN 'Biol.replicates'
    WHEN 2 THEN 'Same Barcode Different Site' ELSE 'Different Barcode' END"""
block(
    "classed",
    f"""SELECT a, b, dist, class_order, {CLASS_NAME} AS pair_class FROM (
        SELECT x.unit AS a, y.unit AS b, dist, {CLASS_ORDER} AS class_order
        FROM units x JOIN units y ON x.unit < y.unit LEFT JOIN all_pairs p ON p.a = x.unit AND p.b = y.unit)""",
)
block("centres", centres_sql("in_values", "in_pairs"))
block("outliers", outliers_sql("centres", 0.9))

# log and tables


def summary_sql(rows: str, stage: str) -> str:
    numbers = {
        "nsamples": "count(DISTINCT sample)",
        "nHashes": "count(DISTINCT feature)",
        "nReads": "CAST(sum(reads) AS BIGINT)",
    }
    return " UNION ALL ".join(
        f"SELECT run, '{stat}' AS stat, {expr} AS number, '{stage}' AS stage FROM {rows} GROUP BY run"
        for stat, expr in numbers.items()
    )


block("by_sample", "SELECT taxon, run, sample, CAST(sum(reads) AS BIGINT) AS reads FROM samples GROUP BY ALL")
block(
    "shares",
    "SELECT *, coalesce(reads / nullif(CAST(sum(reads) OVER (PARTITION BY run, sample) AS BIGINT), 0), 0) AS share FROM by_sample",
)
block("summed", "SELECT taxon, sample, CAST(sum(reads) AS BIGINT) AS reads FROM samples GROUP BY ALL")
block("by_site", "SELECT taxon, site, CAST(sum(reads) AS BIGINT) AS reads FROM samples GROUP BY ALL")
block(
    "site_shares",
    """SELECT *, share / max(share) OVER (PARTITION BY taxon) AS index FROM (
       SELECT *, mean_reads / sum(mean_reads) OVER (PARTITION BY site) AS share FROM (
       SELECT taxon, site, avg(reads) AS mean_reads FROM samples GROUP BY ALL))""",
)


def cells_sql(rows: str, index: str, column: str, value: str, cell: str = "coalesce({}, 0)", per: str = "") -> str:
    """Every index and column of ``rows`` (of each ``per``) as a row, 0 where there is none."""
    by = f"{per}, " if per else ""
    names = f"(SELECT DISTINCT {by}{column} FROM {rows})"
    pairs = f"JOIN {names} USING ({per})" if per else f"CROSS JOIN {names}"
    return f"""SELECT {by}{index}, {column}, {cell.format("v")} AS {value}
        FROM (SELECT DISTINCT {by}{index} FROM {rows}) {pairs}
        LEFT JOIN (SELECT {by}{index}, {column}, first({value}) AS v FROM {rows} GROUP BY ALL) USING ({by}{index}, {column})"""


RAW = "'lib.' || substr(sample, 2) || '.S1'"
block("wide_runs", f"SELECT run, feature, taxon, {RAW} AS sample, reads FROM merged")
block("bottles", "SELECT run, feature, taxon, run || '_' || coalesce(bio_rep, 'none') AS bottle, reads FROM labelled")
block("matrix", "SELECT feature, taxon, sample, CAST(sum(reads) AS BIGINT) AS reads FROM merged GROUP BY ALL")
block("libraries", "SELECT taxon, run || '_' || sample AS library, reads FROM by_sample")
block(
    "aligned",
    """SELECT taxon, sample, CAST(sum(reads) AS BIGINT) AS reads FROM (
       SELECT taxon, sample, reads FROM samples
       UNION ALL SELECT taxon, 'unlisted', reads FROM samples
       UNION ALL SELECT taxon, 'unread', 0 FROM samples
       UNION ALL SELECT taxon, sheet.sample, 0 FROM (SELECT DISTINCT taxon FROM samples) t, sheet
       WHERE sample_control = 'Sample') GROUP BY ALL""",
)
block(
    "placed",
    """SELECT c.*, sheet.site, sheet.control_type
       FROM (SELECT * FROM counts UNION ALL SELECT * REPLACE ('unlisted.' || sample AS sample) FROM counts) c
       LEFT JOIN sheet USING (sample)""",
)
block(
    "vector_span",
    "SELECT run, min(v) AS low, (max(v) - min(v)) / 29.0 AS width FROM vector GROUP BY run",
)
block(
    "site_span",
    "SELECT min(occupancy) AS low, (max(occupancy) - min(occupancy)) / 29.0 AS width FROM o_results",
)

# whole runs


def run_blocks(p: str, mode: str, thresh: float, cutoff: str) -> None:
    """Blocks for steps 2 to 5 on top of step 1, and the log of all six stages."""
    group = "site, bio_rep" if mode == "double" else "site"
    grp = GROUP if mode == "double" else "run || ':' || site"
    unit = UNIT if mode == "double" else GROUP
    last = "tech_rep" if mode == "double" else "bio_rep"
    block(f"{p}depth", depth_sql("step1"))
    gamma_blocks(p, f"{p}depth")
    block(f"{p}bad", f"SELECT sample FROM {p}prob WHERE prob < 0.05 OR tot < 2400")
    block(f"{p}step2", f"SELECT * FROM step1 WHERE sample NOT IN (SELECT sample FROM {p}bad)")
    block(f"{p}r1", clean_round_sql(f"{p}step2", "profile"))
    block(f"{p}r2", clean_round_sql(f"{p}r1", "profile"))
    block(f"{p}sizes", sizes_sql(f"{p}step2", group))
    block(f"{p}zero", zero_filter_sql(f"{p}r2", "blanks", f"{p}sizes", thresh, group))
    block(f"{p}step3", prop_filter_sql(f"{p}zero", "blanks", 5e-5, group))
    block(f"{p}found", found_sql(f"{p}step3", mode))
    occupancy_blocks(f"{p}o_", f"{p}found", mode)
    block(
        f"{p}kept",
        f"SELECT taxon FROM {p}o_results, {p}o_cutoffs WHERE round(occupancy, 9) >= round({cutoff}, 9)",
    )
    block(f"{p}step4", f"SELECT * FROM {p}step3 WHERE taxon IN (SELECT taxon FROM {p}kept)")
    block(f"{p}indexed", index_sql(f"{p}step4"))
    block(
        f"{p}several",
        f"""SELECT * FROM {p}indexed SEMI JOIN (SELECT run, {group} FROM {p}indexed GROUP BY run, {group}
            HAVING count(DISTINCT {last}) > 1) USING (run, {group})""",
    )
    block(f"{p}values", values_sql(f"{p}several", grp, unit, "taxon"))
    block(f"{p}pairs", pairs_sql(f"{p}values"))
    block(f"{p}centres", centres_sql(f"{p}values", f"{p}pairs"))
    block(f"{p}outliers", outliers_sql(f"{p}centres", 0.975))
    block(f"{p}step5", f"SELECT * FROM {p}step4 WHERE {unit} NOT IN (SELECT unit FROM {p}outliers)")
    stages = {
        "samples": "Step_0",
        "step1": "Step_1.Jump",
        f"{p}step2": "Step_2.Low.Read.Depth",
        f"{p}step3": "Step_3.microDecon",
        f"{p}step4": "Step_4.Occupancy",
        f"{p}step5": "Step_5.Dissimilarity",
    }
    block(f"{p}log", " UNION ALL ".join(summary_sql(rows, stage) for rows, stage in stages.items()))


run_blocks("w_", "double", 0.7, "som_min_threshold_1")
run_blocks("ws_", "single", 0.9, "som_min_threshold_2")

KEYS = "run, sample, feature, taxon, reads"

STATEMENTS: dict[str, str] = {
    "read_wide": cells_sql("wide_runs", "feature, taxon", "sample", "reads", per="run"),
    "to_long": "SELECT * FROM wide_runs",
    "read_sheet": "SELECT * FROM sheet",
    "sheet_dedupe": "SELECT * EXCLUDE (raw_name) FROM sheet",
    "taxon_key": "SELECT DISTINCT feature, taxon FROM counts",
    "taxon_dim": """SELECT taxon, 'taxon_' || row_number() OVER (ORDER BY md5(taxon), taxon) AS taxon_id,
        min(feature) AS first_feature FROM counts GROUP BY taxon""",
    "taxon_dim_second_load": """SELECT taxon, 'taxon_' || (n + CASE WHEN load = 1 THEN 0 ELSE coalesce(max(n) FILTER (load = 1) OVER (), 0) END) AS taxon_id, first_feature
        FROM (SELECT taxon, load, CASE WHEN load = 1 THEN early ELSE any_feature END AS first_feature,
          row_number() OVER (PARTITION BY load ORDER BY md5(taxon) NULLS FIRST, taxon) AS n
          FROM (SELECT taxon, min(feature) AS any_feature, min(feature) FILTER (first) AS early, CASE WHEN bool_or(first) THEN 1 ELSE 2 END AS load
            FROM (SELECT CASE WHEN NOT starts_with(taxon, 'Brand#1;') THEN taxon END AS taxon, feature, run = 'F' AND feature LIKE '%7' AS first FROM counts)
            GROUP BY taxon))""",
    "run_label": """SELECT regexp_extract(feature, '^[a-z]+_(.*)_[0-9]+$', 1) AS run, sample, feature, reads
        FROM counts""",
    "rename_samples": f"""SELECT run, coalesce(s.sample, {RAW.replace('sample', 'c.sample')}) AS sample, feature, taxon, reads
        FROM counts c LEFT JOIN (SELECT sample FROM sheet) s ON c.sample = s.sample
        UNION ALL SELECT run, 'unlisted.' || {RAW}, feature, taxon, reads FROM counts""",
    "union_runs": """SELECT feature, taxon, n.bottle, CAST(coalesce((sum(reads) FILTER (WHERE b.bottle = n.bottle)), 0) AS BIGINT) AS reads
        FROM bottles b CROSS JOIN (SELECT DISTINCT bottle FROM bottles) n GROUP BY run, feature, taxon, n.bottle""",
    "write_csv": "SELECT feature, taxon, CAST(sum(reads) AS BIGINT) AS tot FROM positives GROUP BY ALL",
    "write_table": "SELECT * FROM merged",
    "keep_merged": "SELECT * FROM merged",
    "keep_merged_forward": "SELECT * FROM counts WHERE NOT contains(feature, 'reverse') AND NOT contains(feature, 'unmerged')",
    "drop_singletons": "SELECT * FROM counts WHERE feature IN (SELECT feature FROM counts GROUP BY feature HAVING sum(reads) > 20)",
    "retention_pct": """SELECT features_before, features_after, round(100.0 * features_after / features_before, 2) AS pct
        FROM (SELECT count(DISTINCT run || feature) AS features_before FROM counts),
             (SELECT count(DISTINCT run || feature) AS features_after FROM merged)""",
    "control_lists": """SELECT sample, 'controls' AS list FROM sheet WHERE sample_control = 'Control'
        UNION ALL SELECT sample, 'positives' FROM sheet WHERE control_type = 'Pos'
        UNION ALL SELECT sample, 'blanks' FROM sheet WHERE control_type = 'Blank'""",
    "label_source": f"SELECT {KEYS}, source FROM labelled",
    "drop_zero": "SELECT * FROM counts WHERE reads > 0",
    "control_features": "SELECT feature, taxon, CAST(sum(reads) AS BIGINT) AS tot FROM blanks GROUP BY ALL",
    "null_profile": " UNION ALL ".join(
        f'SELECT \'{c}\' AS "column", count(*) - count({c}) AS missing, count({c}) AS present FROM '
        + ("(SELECT * REPLACE (coalesce(site, 'NA') AS site) FROM placed)" if c == "site" else "placed")
        for c in ("run", "sample", "feature", "taxon", "reads", "site", "control_type")
    ),
    "contam_vector": "SELECT run, feature, round(v, 6) AS v FROM vector",
    "subtract_proportional": "SELECT * FROM step1",
    "contam_hist": f"""SELECT run, {bin_sql('v', 'low', 'width')} AS bin, count(*) AS n
        FROM vector JOIN vector_span USING (run) GROUP BY ALL""",
    "sample_depth": "SELECT run, sample, source, CAST(sum(reads) AS BIGINT) AS tot FROM labelled GROUP BY ALL",
    "gamma_fit": f"SELECT {rounded('scale shape')}, n FROM g_fit",
    "gamma_prob": "SELECT run, sample, tot, round(prob, 6) AS prob FROM g_prob",
    "depth_outliers": "SELECT * FROM bad",
    "drop_samples": "SELECT * FROM samples WHERE sample NOT IN (SELECT sample FROM bad)",
    "blank_rows": "SELECT * FROM labelled WHERE source = 'Blanks'",
    "top_feature": "SELECT * FROM merged QUALIFY row_number() OVER (PARTITION BY run ORDER BY reads DESC, feature, sample) <= 5",
    "count_matrix": cells_sql("matrix", "feature, taxon", "sample", "reads"),
    "group_sizes": sizes_sql("labelled"),
    "group_sizes_single": sizes_sql("samples", "site"),
    "mean_blank": "SELECT run, feature, round(b, 6) AS b FROM profile",
    "blank_subtract": "SELECT * FROM round2",
    "blank_subtract_rank3": "SELECT * FROM third2",
    "group_zero_filter": zero_filter_sql("samples", "blanks", "sizes", 0.7),
    "group_prop_filter": prop_filter_sql("samples", "blanks", 1e-3),
    "reads_removed": """SELECT *, reads_before - reads_after AS removed FROM (
        SELECT run, feature, coalesce(x, 0) AS reads_before, coalesce(y, 0) AS reads_after FROM
        (SELECT run, feature, CAST(sum(reads) AS BIGINT) AS x FROM samples GROUP BY ALL) FULL JOIN
        (SELECT run, feature, CAST(sum(reads) AS BIGINT) AS y FROM step1 GROUP BY ALL) USING (run, feature))""",
    "detections": "SELECT * FROM found",
    "replicate_count": "SELECT * FROM o_k",
    "detection_counts": "SELECT * FROM o_cells",
    "detection_counts_single": "SELECT feature, taxon, site, count(*) AS n_det FROM found_single GROUP BY ALL",
    "presence_pattern": "SELECT * FROM o_patterns",
    "presence_pattern_single": "SELECT * FROM os_patterns",
    "unique_patterns": "SELECT * FROM o_unique",
    "occupancy_fit": "SELECT * FROM o_fit",
    "occupancy_prob": f"SELECT * EXCLUDE (mean, sd), {rounded('mean sd')} FROM o_probs",
    "occupancy_prob_single": f"SELECT * EXCLUDE (mean, sd), {rounded('mean sd')} FROM os_probs",
    "occupancy_plugin": """SELECT *, round(0.6 * 0.4 ** n * 0.6 ** (k - n)
        / (0.6 * 0.4 ** n * 0.6 ** (k - n) + 0.4 * 0.1 ** n * 0.9 ** (k - n)), 6) AS prob FROM o_rows""",
    "site_max_occupancy": f"SELECT feature, site, {rounded('occupancy')} FROM o_best",
    "attach_occupancy": f"SELECT * REPLACE ({rounded('occupancy')}) FROM o_results",
    "occupancy_cutoffs": f"SELECT {rounded('som_min_threshold_1 som_min_threshold_2 som_min_threshold_3')} FROM o_cutoffs",
    "occupancy_verdict": """SELECT to_keep, n, round(100.0 * n / sum(n) OVER (), 2) AS per FROM (
        SELECT CASE WHEN round(occupancy, 9) < round(som_min_threshold_1, 9) THEN 'Toss'
            WHEN round(occupancy, 9) > round(som_min_threshold_2, 9) THEN 'Keep' ELSE 'Borderline' END AS to_keep,
        count(*) AS n FROM o_results, o_cutoffs GROUP BY ALL)""",
    "occupancy_filter": f"""SELECT * EXCLUDE (occupancy, som_min_threshold_1, som_min_threshold_2, som_min_threshold_3),
        {rounded('occupancy')} FROM o_results, o_cutoffs WHERE round(occupancy, 9) >= round(som_min_threshold_1, 9)""",
    "keep_taxa": """SELECT * FROM samples WHERE feature IN (
        SELECT feature FROM o_results, o_cutoffs WHERE round(occupancy, 9) >= round(som_min_threshold_2, 9))""",
    "occupancy_hist": f"SELECT {bin_sql('occupancy', 'low', 'width')} AS bin, count(*) AS n FROM o_results, site_span GROUP BY ALL",
    "attach_sheet": "SELECT * EXCLUDE (source) FROM labelled",
    "table_size": "SELECT count(DISTINCT sample) AS samples, count(DISTINCT feature) AS features FROM samples",
    "edna_index": f"SELECT * EXCLUDE (share, index), {rounded('share index')} FROM indexed",
    "bray_curtis": f"SELECT a, b, {rounded('dist')} FROM all_pairs",
    "bray_curtis_within": all_pairs_sql("in_values", "in_pairs"),
    "bray_curtis_within_single": all_pairs_sql("single_values", "single_pairs"),
    "pair_class": f"""SELECT a, b, {rounded('dist')}, class_order, pair_class FROM classed WHERE dist IS NOT NULL
        UNION ALL SELECT b AS a, a AS b, {rounded('dist')}, class_order, pair_class FROM classed WHERE dist IS NOT NULL""",
    "pair_hist": f"""SELECT pair_class, class_order, bin, n,
        round(n / (sum(n) OVER (PARTITION BY pair_class) * 0.05::DOUBLE), 6) AS density FROM (
        SELECT pair_class, class_order, {bin_sql('round(coalesce(dist, 1), 9)', '0', '0.05::DOUBLE')} AS bin, count(*) AS n
        FROM classed GROUP BY ALL)""",
    "lone_replicates": """SELECT run, site, bio_rep FROM (SELECT run, site, bio_rep, tech_rep FROM labelled
        UNION ALL SELECT run, site, 'alone', '1' FROM labelled)
        GROUP BY ALL HAVING count(DISTINCT tech_rep) = 1""",
    "pairs_per_group": "SELECT grp, count(DISTINCT unit) * (count(DISTINCT unit) - 1) // 2 AS n_pairs FROM in_values GROUP BY grp",
    "centroid_distance": f"SELECT grp, unit, {rounded('distance')} FROM centres",
    "normal_fit": "SELECT round(avg(distance), 6) AS mu, round(stddev_pop(distance), 6) AS sd FROM centres",
    "normal_prob": f"""SELECT grp, unit, {rounded('distance')}, round(any_value(0.5) + any_value(exp(-z * z / 2) / sqrt(2 * pi()))
          * sum(z * (z * z) ** j / exp((j + 1) * ln(2) + lgamma(j + 1.5) - 0.5 * ln(pi()))), 6) AS prob
        FROM (SELECT grp, unit, distance, (distance - avg(distance) OVER ()) / stddev_pop(distance) OVER () AS z FROM centres),
             (SELECT unnest(range(100)) AS j) GROUP BY grp, unit, distance""",
    "distance_outliers": f"SELECT grp, unit, {rounded('distance')} FROM outliers",
    "drop_replicates": f"""SELECT * EXCLUDE (share, index), {rounded('share index')} FROM indexed
        WHERE {UNIT} NOT IN (SELECT unit FROM outliers)""",
    "replication_level": f"""SELECT run, site, bio_rep, count(DISTINCT tech_rep) AS cases FROM indexed
        WHERE {UNIT} NOT IN (SELECT unit FROM outliers) GROUP BY ALL""",
    "stage_summary": summary_sql("samples", "Step_0"),
    "stage_log": summary_sql("samples", "Step_0") + " UNION ALL " + summary_sql("step1", "Step_1.Jump"),
    "taxon_by_sample": "SELECT * FROM by_sample",
    "taxon_by_sample_wide": cells_sql("libraries", "taxon", "library", "reads"),
    "align_samples": cells_sql("aligned", "taxon", "sample", "reads"),
    "to_proportion": f"SELECT * REPLACE ({rounded('share')}) FROM shares",
    "scale_by_max": f"""SELECT taxon, run, sample, reads, {rounded('share')},
        round(share / max(share) OVER (PARTITION BY run, taxon), 6) AS index FROM shares""",
    "combine_runs_index": f"""SELECT taxon, run, sample, reads, {rounded('share')},
        round(share / max(share) OVER (PARTITION BY taxon), 6) AS index FROM shares""",
    "combine_runs_index_double": f"""SELECT taxon, run, sample, reads, {rounded('share')},
        round(i / max(i) OVER (PARTITION BY taxon), 6) AS index
        FROM (SELECT *, share / max(share) OVER (PARTITION BY run, taxon) AS i FROM shares)""",
    "sum_runs": "SELECT * FROM summed",
    "sum_runs_index": f"""SELECT taxon, sample, reads, {rounded('share')},
        round(share / max(share) OVER (PARTITION BY taxon), 6) AS index
        FROM (SELECT *, reads / CAST(sum(reads) OVER (PARTITION BY sample) AS BIGINT) AS share FROM summed)""",
    "site_reads": cells_sql("by_site", "taxon", "site", "reads"),
    "site_index": cells_sql("site_shares", "taxon", "site", "index", "round(coalesce({}, 0), 6)"),
    "attach_taxon": "SELECT * FROM summed",
    "cleaned_log": "SELECT * FROM w_log",
    "cleaned_counts": "SELECT * FROM w_step5",
    "cleaned_site_index": """SELECT taxon, site, round(share / max(share) OVER (PARTITION BY taxon), 6) AS index FROM (
        SELECT *, mean_reads / sum(mean_reads) OVER (PARTITION BY site) AS share FROM (
        SELECT taxon, site, avg(reads) AS mean_reads FROM w_step5 GROUP BY ALL))""",
    "cleaned_single_log": "SELECT * FROM ws_log",
}

ORACLES: dict[str, str] = {name: with_blocks(sql) for name, sql in STATEMENTS.items()}
