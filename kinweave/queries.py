"""Registered queries of the linkage operators, and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions import similarity as S
from kinweave.functions import text as X
from kinweave.functions.address import all_numbers, house_number, inline_pin, street_name
from kinweave.functions.names import normalize_names
from kinweave.operators import blocking as B
from kinweave.operators import decide as R
from kinweave.operators import learn as L
from kinweave.operators import model as M
from kinweave.operators import pairs as P
from kinweave.operators import reports as T
from kinweave.operators import sampling as H
from kinweave.plans import linkage
from kinweave.plans.fixtures import duck, frame
from kinweave.sources.tables import ranked_lists, truth_edges

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function as a query; ``sql`` is its equivalent on the derived tables."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = duck(sql)
        return f

    return add


# Scans and projections.
@query("SELECT entity_id, business_name, business_address, country FROM er_s1 UNION ALL SELECT * FROM er_s2 UNION ALL SELECT * FROM er_s3")
def s01_entities(spark, d):
    a, b, c = (frame(spark, d, n) for n in ("er_s1", "er_s2", "er_s3"))
    return a.unionByName(b).unionByName(c)


@query("SELECT s.entity_id AS s1_id, t.x_id FROM er_s1 s LEFT JOIN er_truth t ON t.s1_id = s.entity_id")
def s03_truth_edges(spark, d):
    s1, t = frame(spark, d, "er_s1"), frame(spark, d, "er_truth")
    lists = ranked_lists(s1.withColumnRenamed("entity_id", "s1_id"), t.withColumn("p", F.lit(1.0)), "p", "matched_entity_ids")


    return truth_edges(lists)


@query()
def f01_hash_predicates(spark, d):
    e = F.col("entity_id")
    cols = {"sampled": H.in_sample(e, 2), "trained": H.in_train_fraction(e, 0.3), "shard0": H.in_shard(e, 0, 8), "fold": H.fold_of(e, 5), "holdout": H.is_holdout(e), "half": H.tuning_half(e)}
    return frame(spark, d, "er_s1").select("entity_id", *(c.alias(n) for n, c in cols.items()))


@query()
def f06_sample_closure(spark, d):
    kept = frame(spark, d, "er_s1").where(H.in_sample("entity_id", 20))
    linked = frame(spark, d, "er_truth").join(kept.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi").select(F.col("x_id").alias("entity_id"))
    return H.sample_closure(frame(spark, d, "er_s2"), linked, 20, False).select("entity_id")


@query("SELECT entity_id, country, CASE WHEN country IN (SELECT country FROM er_n1) THEN country ELSE '__other__' END AS grp FROM er_nx")
def j04_open_groups(spark, d):
    return B.tag_groups(frame(spark, d, "er_n1"), frame(spark, d, "er_nx")).select("entity_id", "country", "grp")


# Text.
@query(r"""SELECT entity_id, trim(regexp_replace(business_address, '\s+', ' ', 'g')) AS squashed, translate(lower(business_name), '0134578@$', 'oleastbas') AS candidate,
regexp_matches(business_name, '^[a-z]') AS starts_low FROM er_s2""")
def x04_text(spark, d):
    e = frame(spark, d, "er_s2")
    return e.select("entity_id", X.squash(F.col("business_address")).alias("squashed"), X.homoglyph_candidate(F.lower("business_name")).alias("candidate"), F.col("business_name").rlike("^[a-z]").alias("starts_low"))




def _squeezed(c: str) -> str:
    s = f"substr({c}, 1, 1) || regexp_replace(substr({c}, 2), '[aeiouyhw]', '', 'g')"
    for letter in "abcdefghijklmnopqrstuvwxyz":
        s = f"regexp_replace({s}, '{letter}{letter}+', '{letter}', 'g')"
    return s


@query(f"SELECT DISTINCT w AS word, {_squeezed('w')} AS sound FROM (SELECT unnest(string_split(lower(nm), ' ')) AS w FROM er_base)")
def x07_phonetic(spark, d):
    w = frame(spark, d, "er_base").select(F.explode(X.words(F.lower("nm"))).alias("word")).distinct()
    return w.select("word", X.phonetic_squeeze(F.col("word")).alias("sound"))


@query("SELECT a.nm AS a, b.nm AS b, CASE WHEN levenshtein(a.nm, b.nm) > 6 THEN 7 ELSE levenshtein(a.nm, b.nm) END AS d FROM (SELECT DISTINCT nm FROM er_base) a, (SELECT DISTINCT nm FROM er_base) b WHERE a.nm < b.nm AND substr(a.nm, 1, 1) = substr(b.nm, 1, 1)")
def x08_edit_distance(spark, d):
    n = frame(spark, d, "er_base").select("nm", F.substring("nm", 1, 1).alias("i")).distinct()
    met = n.withColumnRenamed("nm", "a").join(n.withColumnRenamed("nm", "b"), "i").where("a < b")
    return met.select("a", "b", X.edit_distance(F.col("a"), F.col("b"), 6).alias("d"))


@query()
def n16_names(spark, d):
    return normalize_names(frame(spark, d, "er_s1").unionByName(frame(spark, d, "er_s2")).unionByName(frame(spark, d, "er_s3"))).drop("business_address")


@query("""SELECT entity_id, array_to_string(list_filter(w, lambda x: x NOT IN ('pvt', 'ltd', 'llc', 'inc')), ' ') AS name_core,
array_to_string(list_sort(list_distinct(list_filter(w, lambda x: x NOT IN ('pvt', 'ltd', 'llc', 'inc')))), ' ') AS name_key,
array_to_string(list_sort(list_distinct(list_filter(w, lambda x: x IN ('pvt', 'ltd', 'llc', 'inc')))), ' ') AS legal
FROM (SELECT entity_id, string_split(trim(regexp_replace(lower(business_name), '[^a-z0-9 ]+', ' ', 'g')), ' ') AS w FROM er_s1)""")
def n12_name_keys(spark, d):
    return normalize_names(frame(spark, d, "er_s1")).select("entity_id", "name_core", "name_key", "legal")


@query()
def d18_addresses(spark, d):
    every = frame(spark, d, "er_s1").unionByName(frame(spark, d, "er_s2")).unionByName(frame(spark, d, "er_s3"))
    return linkage.normalize(every)


@query(r"""SELECT entity_id, coalesce(CAST(TRY_CAST(regexp_extract(a, '\d+') AS BIGINT) AS VARCHAR), '') AS house, coalesce(CAST(TRY_CAST(regexp_extract(a, '\d+') AS BIGINT) AS VARCHAR), '') AS numbers,
array_to_string(list_filter(string_split(a, ' '), lambda w: NOT regexp_full_match(w, '\d+')), ' ') AS street, '' AS pin
FROM (SELECT entity_id, lower(string_split(business_address, ',')[1]) AS a FROM er_s1)""")
def d12_street_pieces(spark, d):
    first = X.words(F.lower(F.split("business_address", ",")[0]))
    return frame(spark, d, "er_s1").select("entity_id", house_number(first).alias("house"), all_numbers(first).alias("numbers"), street_name(first).alias("street"), inline_pin(F.lower("business_address")).alias("pin"))


# Blocking.
_FEATURES = """feats AS (
SELECT entity_id, src, country, 'k:' || name_key AS feature, 2.0 AS wt FROM {t}
UNION ALL SELECT entity_id, src, country, 't:' || w, 1.0 FROM (SELECT entity_id, src, country, unnest(string_split(name_core, ' ')) AS w FROM {t})
UNION ALL SELECT entity_id, src, country, 'hc:' || house_num || '|' || city, 0.8 FROM {t} WHERE house_num <> '' AND city <> '')"""
_KEPT = ["k", "t", "hc"]


def _some_features(df: DataFrame) -> DataFrame:
    return B.record_features(df.withColumn("name_alt", F.lit(""))).where(F.col("family").isin(_KEPT))


_SCORES = f""", f1 AS (WITH {_FEATURES.format(t="er_n1")} SELECT entity_id, country, feature, count(*) AS times FROM feats GROUP BY 1, 2, 3),
fx AS (WITH {_FEATURES.format(t="er_nx")} SELECT DISTINCT entity_id, src, CASE WHEN country IN (SELECT country FROM er_n1) THEN country ELSE '__other__' END AS grp, feature, wt FROM feats),
n AS (SELECT src, grp, count(DISTINCT entity_id) AS n FROM fx GROUP BY 1, 2),
df AS (SELECT src, grp, feature, count(*) AS df FROM fx GROUP BY 1, 2, 3 HAVING count(*) <= 100),
wx AS (SELECT fx.*, wt * ln(1 + CAST(n AS DOUBLE) / df) AS w FROM fx JOIN df USING (src, grp, feature) JOIN n USING (src, grp)),
scored AS (SELECT f1.entity_id AS s1_id, wx.entity_id AS x_id, wx.src AS src, round(sum(times * w), 6) AS score FROM f1 JOIN wx ON f1.feature = wx.feature AND (wx.grp = '__other__' OR wx.grp = f1.country) GROUP BY 1, 2, 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY s1_id, src ORDER BY score DESC, x_id) AS f, row_number() OVER (PARTITION BY x_id ORDER BY score DESC, s1_id) AS r FROM scored),
cands AS (SELECT s1_id, x_id, src, score, CASE WHEN f <= 10 THEN f ELSE 999 END AS fwd_rank, CASE WHEN r <= 3 THEN r ELSE 999 END AS rev_rank FROM ranked WHERE f <= 10 OR r <= 3)
"""


def _with_scores(sql: str) -> str:
    return duck("SELECT 0").removesuffix(" SELECT 0") + _SCORES + sql


def _scored(spark, d) -> DataFrame:
    s1, x = frame(spark, d, "er_n1"), frame(spark, d, "er_nx")
    fx = _some_features(x).join(B.tag_groups(s1, x).select("entity_id", "src", "grp"), ["entity_id", "src"])
    return B.score_pairs(_some_features(s1), fx, 100)


def _cands(spark, d) -> DataFrame:
    return B.rank_candidates(_scored(spark, d), 10, 3)


def _universe(spark, d) -> DataFrame:
    return frame(spark, d, "er_s1").select(F.col("entity_id").alias("s1_id"))


@query()
def b01_record_features(spark, d):
    return B.record_features(frame(spark, d, "er_n1")).unionByName(B.record_features(frame(spark, d, "er_nx")))


@query()
def a01_document_frequency(spark, d):
    return B.document_frequency(_some_features(frame(spark, d, "er_nx")), ["src"])


ORACLE_SQL["a01_document_frequency"] = duck("SELECT 0").removesuffix(" SELECT 0") + ", " + _FEATURES.format(t="er_nx") + " SELECT src, feature, count(DISTINCT entity_id) AS df FROM feats GROUP BY 1, 2"


@query()
def j01_scores(spark, d):
    return _scored(spark, d)


ORACLE_SQL["j01_scores"] = _with_scores("SELECT * FROM scored")


@query()
def w01_candidates(spark, d):
    return _cands(spark, d)


ORACLE_SQL["w01_candidates"] = _with_scores("SELECT * FROM cands")


@query()
def a22_candidate_lists(spark, d):
    return ranked_lists(_universe(spark, d), _cands(spark, d).where("fwd_rank <= 3"), "score", "candidate_entity_ids")


ORACLE_SQL["a22_candidate_lists"] = _with_scores("SELECT u.entity_id AS source1_entity_id, coalesce(l, '') AS candidate_entity_ids FROM er_s1 u LEFT JOIN (SELECT s1_id, string_agg(x_id, ',' ORDER BY score DESC, x_id) AS l FROM cands WHERE fwd_rank <= 3 GROUP BY 1) c ON c.s1_id = u.entity_id")


@query()
def a16_blocking_report(spark, d):
    return T.blocking_report(_universe(spark, d), frame(spark, d, "er_truth"), _cands(spark, d))


ORACLE_SQL["a16_blocking_report"] = _with_scores(""", e AS (SELECT u.entity_id AS s1_id, (SELECT count(*) FROM er_truth t WHERE t.s1_id = u.entity_id) AS n_true FROM er_s1 u),
h AS (SELECT t.s1_id, count(*) AS found FROM er_truth t JOIN cands c ON c.s1_id = t.s1_id AND c.x_id = t.x_id GROUP BY 1), k AS (SELECT s1_id, count(*) AS n FROM cands GROUP BY 1),
j AS (SELECT e.s1_id, n_true, coalesce(found, 0) AS found, coalesce(n, 0) AS n FROM e LEFT JOIN h USING (s1_id) LEFT JOIN k USING (s1_id))
SELECT round(avg(n), 6) AS pairs_per_s1, round(sum(found) / sum(n_true), 6) AS recall, round(avg(CASE WHEN found = n_true THEN 1 ELSE 0 END), 6) AS covered,
round(avg(CASE WHEN n_true = 0 THEN 1.0 ELSE 1.25 * (found / n_true) / (0.25 + found / n_true) END), 6) AS oracle FROM j""")


@query()
def f08_capped_recall(spark, d):
    return T.capped_recall(frame(spark, d, "er_truth"), _cands(spark, d), [1, 3, 10], [0, 1, 3])


ORACLE_SQL["f08_capped_recall"] = _with_scores("SELECT kf, kr, count(*) AS pairs, sum(CASE WHEN t.x_id IS NULL THEN 0 ELSE 1 END) AS found FROM cands c LEFT JOIN er_truth t ON t.s1_id = c.s1_id AND t.x_id = c.x_id CROSS JOIN (VALUES (1), (3), (10)) a(kf) CROSS JOIN (VALUES (0), (1), (3)) b(kr) WHERE fwd_rank <= kf OR rev_rank <= kr GROUP BY 1, 2")


@query()
def a18_recall_by_group(spark, d):
    return T.recall_by_group(frame(spark, d, "er_truth"), _cands(spark, d), frame(spark, d, "er_s1"))


ORACLE_SQL["a18_recall_by_group"] = _with_scores("""SELECT s.country, round(sum(CASE WHEN substr(t.x_id, 2, 1) = '2' AND c.x_id IS NOT NULL THEN 1 ELSE 0 END) / sum(CASE WHEN substr(t.x_id, 2, 1) = '2' THEN 1 ELSE 0 END), 6) AS s2,
round(sum(CASE WHEN substr(t.x_id, 2, 1) = '3' AND c.x_id IS NOT NULL THEN 1 ELSE 0 END) / sum(CASE WHEN substr(t.x_id, 2, 1) = '3' THEN 1 ELSE 0 END), 6) AS s3
FROM er_truth t JOIN er_s1 s ON s.entity_id = t.s1_id LEFT JOIN cands c ON c.s1_id = t.s1_id AND c.x_id = t.x_id GROUP BY 1""")


# The whole job: all families, other names, and the plan's cap and ranks. The queries above are the part that SQL follows.
def _whole(spark, d) -> DataFrame:
    return linkage.candidates(frame(spark, d, "er_n1"), frame(spark, d, "er_nx"))


@query()
def w02_whole_candidates(spark, d):
    return _whole(spark, d)


@query()
def a23_whole_candidate_lists(spark, d):
    return ranked_lists(_universe(spark, d), _whole(spark, d), "score", "candidate_entity_ids")


@query()
def a24_whole_blocking_report(spark, d):
    return T.blocking_report(_universe(spark, d), frame(spark, d, "er_truth"), _whole(spark, d))


@query()
def f09_whole_capped_recall(spark, d):
    return T.capped_recall(frame(spark, d, "er_truth"), _whole(spark, d), [1, 3, 10, 30], [0, 1, 3])


@query()
def a26_whole_recall_by_group(spark, d):
    return T.recall_by_group(frame(spark, d, "er_truth"), _whole(spark, d), frame(spark, d, "er_s1"))


@query()
def t06_whole_misses(spark, d):
    return T.misses(frame(spark, d, "er_truth"), _whole(spark, d), 15)


@query()
def p02_whole_cheap_features(spark, d):
    return P.cheap_features(P.attach_sides(_whole(spark, d), frame(spark, d, "er_n1"), frame(spark, d, "er_nx")))


# Decisions on a probability by formula.
_WINDOWS = "SELECT *, rank() OVER (PARTITION BY s1_id ORDER BY p DESC) AS c_rank_s1, round(max(p) OVER (PARTITION BY s1_id) - p, 9) AS c_gap_s1, sum(CASE WHEN p > 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY s1_id) AS c_n_hi_s1, round(sum(p) OVER (PARTITION BY s1_id), 9) AS c_sum_s1, rank() OVER (PARTITION BY x_id ORDER BY p DESC) AS c_rank_x, round(max(p) OVER (PARTITION BY x_id) - p, 9) AS c_gap_x, count(*) OVER (PARTITION BY x_id) AS c_n_x, coalesce(nth_value(p, 2) OVER (PARTITION BY x_id ORDER BY p DESC, s1_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0.0) AS second, max(p) OVER (PARTITION BY x_id) AS top FROM er_scored"


@query(f"SELECT s1_id, x_id, src, p, score, y, c_rank_s1, c_gap_s1, c_n_hi_s1, c_sum_s1, c_rank_x, c_gap_x, c_n_x, round(CASE WHEN c_rank_x = 1 THEN p - second ELSE p - top END, 9) AS c_margin_x FROM ({_WINDOWS})")
def c21_competition(spark, d):
    return P.competition(frame(spark, d, "er_scored"), "p", "c_")


_OWNED = "owned AS (SELECT s1_id, x_id, p FROM (SELECT *, row_number() OVER (PARTITION BY x_id ORDER BY p DESC, s1_id) AS r, coalesce(lead(p) OVER (PARTITION BY x_id ORDER BY p DESC, s1_id), 0.0) AS s FROM er_scored) WHERE r = 1 AND p - s >= 0.005)"
_EXPECTED = f"""{_OWNED}, e0 AS (SELECT *, sum(p) OVER (PARTITION BY s1_id ORDER BY p DESC, x_id ROWS UNBOUNDED PRECEDING) AS tp, row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, x_id) AS k, sum(p) OVER (PARTITION BY s1_id) AS tot, exp(sum(ln(greatest(1 - p, 1e-9))) OVER (PARTITION BY s1_id)) AS none FROM owned),
e1 AS (SELECT *, CASE WHEN p < 0.2 THEN -1.0 ELSE round(1.25 * tp / (1.25 * tp + 0.25 * (tot - tp) + k - tp), 9) END AS ef FROM e0), e2 AS (SELECT *, max(ef) OVER (PARTITION BY s1_id) AS best FROM e1),
e3 AS (SELECT *, min(CASE WHEN ef = best THEN k END) OVER (PARTITION BY s1_id) AS bk FROM e2), chosen AS (SELECT s1_id, x_id, p FROM e3 WHERE k <= bk AND best > round(none, 9))"""


def _pre(sql: str) -> str:
    return duck("SELECT 0").removesuffix(" SELECT 0") + ", " + sql


@query()
def r02_one_owner(spark, d):
    return R.one_owner(frame(spark, d, "er_scored"), 0.005).select("s1_id", "x_id", "p")


ORACLE_SQL["r02_one_owner"] = _pre(f"{_OWNED} SELECT * FROM owned")


@query("SELECT s1_id, x_id, p FROM (SELECT *, max(p) OVER (PARTITION BY x_id) AS m FROM er_scored) WHERE p = m AND p >= 0.5")
def w10_best_with_ties(spark, d):
    return R.above(R.best_with_ties(frame(spark, d, "er_scored")), 0.5).select("s1_id", "x_id", "p")


@query()
def r03_expected_f05(spark, d):
    return R.decide(frame(spark, d, "er_scored"), "expected", 0.005, p_min=0.2, alpha=1.0).select("s1_id", "x_id", "p")


ORACLE_SQL["r03_expected_f05"] = _pre(f"{_EXPECTED} SELECT * FROM chosen")

_MACRO = """, t AS (SELECT s1_id, count(*) AS n_true FROM er_truth GROUP BY 1), h AS (SELECT c.s1_id, count(*) AS n_pred, sum(CASE WHEN g.x_id IS NULL THEN 0 ELSE 1 END) AS tp FROM chosen c LEFT JOIN er_truth g ON g.s1_id = c.s1_id AND g.x_id = c.x_id GROUP BY 1),
e AS (SELECT u.entity_id, coalesce(n_true, 0) AS n_true, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp FROM er_s1 u LEFT JOIN t ON t.s1_id = u.entity_id LEFT JOIN h ON h.s1_id = u.entity_id),
f AS (SELECT *, CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * (tp / n_pred) + tp / n_true) END AS f05 FROM e)
SELECT count(*) AS n, round(avg(f05), 6) AS macro_f05, round(avg(CASE WHEN n_true = 0 THEN f05 END), 6) AS f05_singletons, round(avg(CASE WHEN n_true > 0 THEN f05 END), 6) AS f05_matched FROM f"""


@query()
def a14_macro_f05(spark, d):
    return R.macro_f05(_universe(spark, d), frame(spark, d, "er_truth"), r03_expected_f05(spark, d))


ORACLE_SQL["a14_macro_f05"] = _pre(_EXPECTED + _MACRO)


@query()
def r05_grid_search(spark, d):
    return R.grid_search(_universe(spark, d), frame(spark, d, "er_truth"), frame(spark, d, "er_scored"), [0.0, 0.2], [0.5, 1.0], [0.3, 0.5, 0.7], [0.0, 0.005])


@query()
def v01_problems(spark, d):
    universe, m = _universe(spark, d), r03_expected_f05(spark, d)
    return R.problems(universe, m, frame(spark, d, "er_scored"))


ORACLE_SQL["v01_problems"] = _pre(f"""{_EXPECTED} SELECT 'repeated pair' AS problem, count(*) AS n FROM (SELECT 1 FROM chosen GROUP BY s1_id, x_id HAVING count(*) > 1)
UNION ALL SELECT 'unknown s1', count(*) FROM chosen WHERE s1_id NOT IN (SELECT entity_id FROM er_s1) UNION ALL SELECT 'wrong prefix', count(*) FROM chosen WHERE NOT regexp_matches(x_id, '^S[23]-')
UNION ALL SELECT 'not a candidate', count(*) FROM chosen c WHERE NOT EXISTS (SELECT 1 FROM er_scored s WHERE s.s1_id = c.s1_id AND s.x_id = c.x_id)
UNION ALL SELECT 'two owners', count(*) FROM (SELECT 1 FROM chosen GROUP BY x_id HAVING count(DISTINCT s1_id) > 1)""")


@query()
def a25_match_report(spark, d):
    return T.match_report(frame(spark, d, "er_s1"), r03_expected_f05(spark, d))


ORACLE_SQL["a25_match_report"] = _pre(f"{_EXPECTED}, k AS (SELECT s1_id, count(*) AS k FROM chosen GROUP BY 1) SELECT country, count(*) AS n, round(count(k) / count(*), 6) AS matched, round(avg(k), 6) AS per_matched FROM er_s1 LEFT JOIN k ON s1_id = entity_id GROUP BY 1")


@query("SELECT s1_id, x_id, p FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, x_id) AS r FROM er_scored) WHERE r <= 4")
def w12_top_k(spark, d):
    return R.top_k(frame(spark, d, "er_scored"), 4, "p").select("s1_id", "x_id", "p")


@query("""SELECT k, round(avg(coalesce(n, 0)), 6) AS pairs_per_s1, round(sum(coalesce(found, 0)) / sum(n_true), 6) AS recall, round(avg(CASE WHEN n_true = 0 THEN 1.0 ELSE 1.25 * (coalesce(found, 0) / n_true) / (0.25 + coalesce(found, 0) / n_true) END), 6) AS oracle
FROM (SELECT u.entity_id AS s1_id, k, (SELECT count(*) FROM er_truth t WHERE t.s1_id = u.entity_id) AS n_true FROM er_s1 u CROSS JOIN (VALUES (1), (2), (4)) g(k))
LEFT JOIN (SELECT s1_id, k, count(*) AS n, sum(y0) AS found FROM (SELECT s.s1_id, row_number() OVER (PARTITION BY s.s1_id ORDER BY p DESC, s.x_id) AS r, CASE WHEN t.x_id IS NULL THEN 0 ELSE 1 END AS y0 FROM er_scored s LEFT JOIN er_truth t ON t.s1_id = s.s1_id AND t.x_id = s.x_id) JOIN (VALUES (1), (2), (4)) g(k) ON r <= k GROUP BY 1, 2) USING (s1_id, k) GROUP BY 1""")
def a17_recall_at(spark, d):
    return R.recall_at(_universe(spark, d), frame(spark, d, "er_truth"), frame(spark, d, "er_scored"), [1, 2, 4], "p")


@query("""SELECT round(sum(pos * tp / k) / sum(pos), 6) AS average_precision FROM (SELECT *, sum(pos) OVER (ORDER BY pr DESC) AS tp, sum(n) OVER (ORDER BY pr DESC) AS k FROM (SELECT round(p, 6) AS pr, sum(y) AS pos, count(*) AS n FROM er_scored GROUP BY 1))""")
def a21_average_precision(spark, d):
    return T.average_precision(frame(spark, d, "er_scored"))


# Learned tables.
@query("SELECT token, df, round(ln(CAST((SELECT count(*) FROM er_nx) AS DOUBLE) / df), 6) AS idf FROM (SELECT token, count(*) AS df FROM (SELECT DISTINCT entity_id, unnest(string_split(name_core, ' ')) AS token FROM er_nx) GROUP BY 1)")
def a03_token_idf(spark, d):
    return L.token_idf(frame(spark, d, "er_nx"))


@query("SELECT country, name_key, count(*) AS n FROM er_nx WHERE name_key <> '' GROUP BY 1, 2")
def a04_key_counts(spark, d):
    return L.key_counts(frame(spark, d, "er_nx"))


@query("SELECT house_num, street, count(*) AS n FROM er_nx WHERE house_num <> '' GROUP BY 1, 2")
def a04_place_counts(spark, d):
    return L.place_counts(frame(spark, d, "er_nx"))


@query("SELECT token, n FROM (SELECT token, count(*) AS n FROM (SELECT unnest(string_split(trim(regexp_replace(lower(business_name), '[^a-z0-9 ]+', ' ', 'g')), ' ')) AS token FROM er_s1) WHERE token <> '' GROUP BY 1) WHERE n >= 3 ORDER BY n DESC, token LIMIT 300000")
def a05_vocabulary(spark, d):
    return L.vocabulary(frame(spark, d, "er_s1"), "business_name")


def _parts(spark, d):
    part = X.squash(F.regexp_replace(F.lower("raw"), "[^a-z0-9 ]+", " "))
    return L.place_parts(frame(spark, d, "er_s1"), part)


_PARTS = """parts AS (SELECT country, name, count(*) AS n, sum(CASE WHEN i = k THEN 1 ELSE 0 END) AS last FROM (SELECT lower(country) AS country, len(string_split(business_address, ',')) AS k, generate_subscripts(string_split(business_address, ','), 1) AS i, lower(trim(unnest(string_split(business_address, ',')))) AS name FROM er_s1) WHERE NOT regexp_matches(name, '[0-9]') GROUP BY 1, 2)"""


@query()
def a06_place_parts(spark, d):
    return _parts(spark, d)


ORACLE_SQL["a06_place_parts"] = _pre(f"{_PARTS} SELECT * FROM parts")


@query()
def a07_cities_and_states(spark, d):
    parts = _parts(spark, d)
    states = L.mine_states(parts, ["us", "usa", "united states", "india", "in"])
    cities = L.mine_cities(parts, states)
    return cities.select("country", "name", F.lit("city").alias("kind")).unionByName(states.withColumn("kind", F.lit("state")))


ORACLE_SQL["a07_cities_and_states"] = _pre(f"{_PARTS}, st AS (SELECT country, name FROM parts WHERE country = 'france' AND n >= 30 AND last / n >= 0.5) SELECT country, name, 'city' AS kind FROM parts WHERE n >= 3 AND (country, name) NOT IN (SELECT country, name FROM st) UNION ALL SELECT country, name, 'state' FROM st")


# Pair features.
def _true_pairs(spark, d):
    return P.attach_sides(frame(spark, d, "er_truth"), frame(spark, d, "er_n1"), frame(spark, d, "er_nx"))


_SIDES = "sides AS (SELECT t.s1_id, t.x_id, a.name_core AS an, b.name_core AS bn, a.house_num AS ah, b.house_num AS bh, a.city AS ac, b.city AS bc, a.street AS ast, b.street AS bst, a.country AS acn, a.legal AS al, b.legal AS bl FROM er_truth t JOIN er_n1 a ON a.entity_id = t.s1_id JOIN er_nx b ON b.entity_id = t.x_id)"


@query()
def c08_native_features(spark, d):
    n = P.native_features()
    kept = ["n_key_lev", "n_key_eq", "n_jacc", "n_len_a", "b_one_tok", "legal_eq", "city_eq", "h_eq", "h_suffix", "h_logdiff", "st_jacc"]
    return _true_pairs(spark, d).select("s1_id", "x_id", *(n[c].alias(c) for c in kept))


_TRI = "CASE WHEN {a} = '' OR {b} = '' THEN -1 WHEN {a} = {b} THEN 1 ELSE 0 END"
_JAC = "CAST(len(list_intersect(list_distinct(string_split({a}, ' ')), list_distinct(string_split({b}, ' ')))) AS DOUBLE) / len(list_distinct(list_concat(string_split({a}, ' '), string_split({b}, ' '))))"
ORACLE_SQL["c08_native_features"] = _pre(f"""{_SIDES} SELECT s1_id, x_id, round(1 - CAST(levenshtein(an, bn) AS DOUBLE) / greatest(length(an), length(bn)), 6) AS n_key_lev, {_TRI.format(a="an", b="bn")} AS n_key_eq, {_JAC.format(a="an", b="bn")} AS n_jacc,
len(string_split(an, ' ')) AS n_len_a, CASE WHEN len(string_split(bn, ' ')) = 1 THEN 1 ELSE 0 END AS b_one_tok, {_TRI.format(a="al", b="bl")} AS legal_eq, {_TRI.format(a="ac", b="bc")} AS city_eq, {_TRI.format(a="ah", b="bh")} AS h_eq,
CASE WHEN ah = '' OR bh = '' THEN -1 WHEN ah <> bh AND (suffix(ah, bh) OR suffix(bh, ah)) THEN 1 ELSE 0 END AS h_suffix, CASE WHEN ah = '' OR bh = '' THEN -1.0 ELSE round(ln(1 + abs(CAST(ah AS DOUBLE) - CAST(bh AS DOUBLE))), 6) END AS h_logdiff, {_JAC.format(a="ast", b="bst")} AS st_jacc FROM sides""")


@query()
def c05_jaro_winkler(spark, d):
    return _true_pairs(spark, d).select("s1_id", "x_id", F.round(S.jaro_winkler_udf()("a_name_core", "b_name_core"), 6).alias("jw"))


ORACLE_SQL["c05_jaro_winkler"] = _pre(f"{_SIDES} SELECT s1_id, x_id, round(jaro_winkler_similarity(an, bn), 6) AS jw FROM sides")


@query()
def c01_fuzzy_features(spark, d):
    made = P.fuzzy_features(_true_pairs(spark, d))
    return made.select("s1_id", "x_id", *(F.round(c, 6).alias(c) for c in ("n_ratio", "n_tsr", "n_clean_tsr", "n_tsort", "n_partial", "n_key_jw", "n_alt_tsr", "st_tsr", "addr_tsr", "addr_ratio")))


@query()
def c10_soft_idf(spark, d):
    idf = L.token_idf(frame(spark, d, "er_nx"))
    return P.soft_idf(_true_pairs(spark, d), idf, 7.0)


@query()
def c17_commonness(spark, d):
    out = P.commonness(_true_pairs(spark, d), frame(spark, d, "er_n1"), frame(spark, d, "er_nx"))
    return out.select("s1_id", "x_id", "key_cnt_s1", "key_cnt_x", "hs_cnt_x")


ORACLE_SQL["c17_commonness"] = _pre(f"""{_SIDES} SELECT s1_id, x_id, round(ln(1 + (SELECT count(*) FROM er_n1 r WHERE r.country = acn AND r.name_key = an)), 6) AS key_cnt_s1, round(ln(1 + (SELECT count(*) FROM er_nx r WHERE r.country = acn AND r.name_key = an)), 6) AS key_cnt_x,
round(ln(1 + (SELECT count(*) FROM er_nx r WHERE r.house_num <> '' AND r.house_num = bh AND r.street = bst)), 6) AS hs_cnt_x FROM sides""")


@query("""SELECT e.entity_id, coalesce(CAST(sum(CASE WHEN token NOT IN (SELECT unnest(string_split(name_core, ' ')) FROM er_n1) THEN 1 ELSE 0 END) AS DOUBLE) / nullif(count(token), 0), -1.0) AS oov
FROM er_nx e LEFT JOIN (SELECT * FROM (SELECT entity_id, unnest(string_split(name_core, ' ')) AS token FROM er_nx) WHERE length(token) >= 4) t ON t.entity_id = e.entity_id GROUP BY 1""")
def c18_out_of_vocabulary(spark, d):
    v = frame(spark, d, "er_n1").select(F.explode(X.words(F.col("name_core"))).alias("token"))
    return P.out_of_vocabulary(frame(spark, d, "er_nx"), v)


@query()
def c19_siblings(spark, d):
    p = frame(spark, d, "er_scored").join(frame(spark, d, "er_nx").select(F.col("entity_id").alias("x_id"), *(F.col(c).alias(f"b_{c}") for c in ("name_core", "addr_clean", "name_key"))), "x_id")
    return P.siblings(p, 0.5)


@query()
def p01_cheap_features(spark, d):
    made = P.cheap_features(P.attach_sides(_cands(spark, d).where("fwd_rank <= 3"), frame(spark, d, "er_n1"), frame(spark, d, "er_nx")))
    return made.select("s1_id", "x_id", "src", "score", "fwd_rank", "rev_rank", "name_key_eq", "name_jacc", "name_tsr", "name_ratio", "legal_eq", "house_eq", "house_missing", "nums_overlap", "street_jacc", "city_eq", "state_eq", "addr_jacc", "addr_missing_x", "score_gap")


# Reports.
@query("SELECT src, country, count(*) AS n, round(avg(CASE WHEN name_core <> '' THEN 1 ELSE 0 END) * 100, 4) AS name_core, round(avg(CASE WHEN house_num <> '' THEN 1 ELSE 0 END) * 100, 4) AS house_num, round(avg(CASE WHEN unit <> '' THEN 1 ELSE 0 END) * 100, 4) AS unit FROM er_nx GROUP BY 1, 2")
def a19_coverage(spark, d):
    return T.coverage(frame(spark, d, "er_nx"), ["name_core", "house_num", "unit"])


@query()
def a20_agreement(spark, d):
    return T.agreement(_true_pairs(spark, d), ["name_key", "house_num", "city"])


ORACLE_SQL["a20_agreement"] = _pre(f"""{_SIDES} SELECT acn AS a_country, count(*) AS n, round(avg(CASE WHEN an <> '' AND bn <> '' THEN CASE WHEN an = bn THEN 1 ELSE 0 END END) * 100, 4) AS name_key, round(avg(CASE WHEN ah <> '' AND bh <> '' THEN CASE WHEN ah = bh THEN 1 ELSE 0 END END) * 100, 4) AS house_num,
round(avg(CASE WHEN ac <> '' AND bc <> '' THEN CASE WHEN ac = bc THEN 1 ELSE 0 END END) * 100, 4) AS city, round(avg(CASE WHEN {_JAC.format(a="an", b="bn")} >= 0.5 THEN 1 ELSE 0 END) * 100, 4) AS name_jaccard_half FROM sides GROUP BY 1""")


@query()
def t05_misses(spark, d):
    return T.misses(frame(spark, d, "er_truth"), _cands(spark, d), 15)


# Models.
@query()
def m01_cross_fit(spark, d):
    rows = p01_cheap_features(spark, d).join(frame(spark, d, "er_truth").withColumn("y", F.lit(1)), ["s1_id", "x_id"], "left").fillna(0, ["y"])
    out, _ = M.cross_fit(rows, ["score", "fwd_rank", "name_tsr", "name_jacc", "house_eq", "city_eq", "addr_jacc"], "p1", folds=3, rounds=5)
    return out.select("s1_id", "x_id", "p1", "y")


@query()
def r01_calibration(spark, d):
    scored = frame(spark, d, "er_scored")
    return M.apply_calibration(M.calibrate(scored), scored, "calibrated").select("s1_id", "x_id", "p", "calibrated")


@query()
def link_records(spark, d):
    s1 = linkage.normalize(frame(spark, d, "er_s1"))
    x = linkage.normalize(frame(spark, d, "er_s2").unionByName(frame(spark, d, "er_s3")))
    return linkage.link(s1, x)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a23_whole_candidate_lists(spark, sf_dir)
