"""DuckDB texts for the checked queries in :mod:`paysight.plans.catalog`.

Each text runs on the driver tables registered as views and must give the
same rows, column names and types as the Spark query of the same name.
The derived ``survey`` view is an inline CTE in every text that needs it.
"""

from __future__ import annotations

from paysight.operators.filters import ROLE_WORDS
from paysight.schema import SURVEY_SCHEMA
from paysight.plans.catalog import CORR_COLS, CSV_NOTE, QUARTILE_DIMS, RARE_MIN, REQUEST_FIELDS, SAMPLE_N, SILVER_COLUMNS

SURVEY_CTE = """survey AS (
  SELECT
    o.o_orderkey AS ResponseId,
    CAST(year(o.o_orderdate) AS INTEGER) AS SurveyYear,
    n.n_name AS Country,
    CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
         WHEN o.o_orderkey % 97 = 0 THEN CAST(0.0 AS DOUBLE)
         ELSE o.o_totalprice END AS ConvertedCompYearly,
    CASE WHEN o.o_orderkey % 13 = 0 THEN NULL
         ELSE o.o_totalprice * (1 + o.o_orderkey % 5) END AS CompTotal,
    CASE o.o_orderstatus WHEN 'F' THEN 'I am a developer by profession'
         WHEN 'P' THEN 'I am not primarily a developer, but I write code'
         ELSE 'I am learning to code' END AS MainBranch,
    CASE WHEN o.o_custkey % 4 = 0 THEN 'Student, full-time'
         WHEN o.o_custkey % 4 = 1 THEN 'Not employed, but looking for work'
         ELSE 'Employed, full-time' END AS Employment,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Developer, back-end'
         WHEN '2-HIGH' THEN 'DevOps specialist'
         WHEN '3-MEDIUM' THEN 'Data scientist or machine learning specialist'
         WHEN '4-NOT SPECIFIED' THEN NULL
         ELSE 'Marketing or sales professional' END AS DevType,
    CASE WHEN o.o_orderkey % 53 = 0 THEN 'Less than 1 year'
         WHEN o.o_orderkey % 53 = 51 THEN 'More than 50 years'
         WHEN o.o_orderkey % 53 = 52 THEN 'NA'
         WHEN o.o_orderkey % 17 = 0 THEN NULL
         ELSE CAST(o.o_orderkey % 53 AS VARCHAR) END AS YearsCodePro,
    CASE o.o_custkey % 6 WHEN 0 THEN 'Under 18 years old' WHEN 1 THEN '18-24 years old'
         WHEN 2 THEN '25-34 years old' WHEN 3 THEN '65 years or older'
         WHEN 4 THEN 'Prefer not to say' ELSE NULL END AS Age,
    c.c_mktsegment AS EdLevel,
    CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE o.o_orderpriority END AS OrgSize,
    CASE o.o_orderkey % 4 WHEN 0 THEN 'Remote' WHEN 1 THEN 'Hybrid (some remote, some in-person)'
         WHEN 2 THEN 'In-person' ELSE NULL END AS RemoteWork,
    CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE concat_ws(';',
         CASE WHEN o.o_orderkey % 2 = 0 THEN 'Python' END,
         CASE WHEN o.o_orderkey % 3 = 0 THEN 'C#' END,
         CASE WHEN o.o_orderkey % 5 = 0 THEN 'Bash/Shell' END,
         CASE WHEN o.o_orderkey % 211 = 0 THEN 'APL' END) END AS LanguageHaveWorkedWith,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE concat_ws(';',
         CASE WHEN o.o_custkey % 2 = 0 THEN 'PostgreSQL' END,
         CASE WHEN o.o_custkey % 3 = 0 THEN 'Redis' END) END AS DatabaseHaveWorkedWith
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

POP_WHERE = (
    "contains(lower(MainBranch), 'developer') AND contains(lower(Employment), 'employed') "
    f"AND regexp_matches(DevType, '(?i)({'|'.join(ROLE_WORDS)})') AND ConvertedCompYearly IS NOT NULL"
)
POSITIVE = "ConvertedCompYearly IS NOT NULL AND ConvertedCompYearly > 0"


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def years_sql(c: str) -> str:
    t = f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    first_int = f"TRY_CAST(NULLIF(regexp_extract({t}, '(\\d+)', 1), '') AS DOUBLE)"
    return (
        f"(CASE WHEN {c} IS NULL THEN NULL "
        f"WHEN {t} = '' OR lower({t}) = 'na' THEN NULL "
        f"WHEN contains(lower({t}), 'less than 1 year') THEN CAST(0.5 AS DOUBLE) "
        f"WHEN contains(lower({t}), 'more than') THEN {first_int} "
        f"ELSE COALESCE(TRY_CAST({t} AS DOUBLE), {first_int}) END)"
    )


def age_sql(c: str) -> str:
    nums = f"regexp_extract_all({c}, '(\\d+)', 1)"
    return (
        f"(CASE WHEN {c} IS NULL THEN NULL "
        f"WHEN contains({c}, 'Under 18') THEN CAST(17.0 AS DOUBLE) "
        f"WHEN contains({c}, '65 years or older') THEN CAST(65.0 AS DOUBLE) "
        f"WHEN len({nums}) = 0 THEN NULL "
        f"WHEN len({nums}) = 1 THEN CAST({nums}[1] AS DOUBLE) "
        f"ELSE (CAST({nums}[1] AS DOUBLE) + CAST({nums}[2] AS DOUBLE)) / 2 END)"
    )


def md5_bucket_sql(k: str) -> str:
    return f"(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8))::BIGINT % 100)"


def tokens_sql(c: str) -> str:
    return f"list_filter(string_split(lower({c}), ';'), lambda t: length(t) >= 1)"


def rare_sql(col: str, k: int) -> str:
    return f"CASE WHEN {col} IS NOT NULL AND count(*) OVER (PARTITION BY {col}) < {k} THEN 'Other' ELSE {col} END"


SILVER_CTES = [
    SURVEY_CTE,
    f"pop AS (SELECT * FROM survey WHERE {POP_WHERE})",
    "b AS (SELECT quantile_disc(ConvertedCompYearly, 0.01) AS lo, quantile_disc(ConvertedCompYearly, 0.99) AS hi FROM pop)",
    f"t AS (SELECT pop.*, {years_sql('YearsCodePro')} AS YearsCodeProNum, {age_sql('Age')} AS AgeNum "
    "FROM pop, b WHERE ConvertedCompYearly >= lo AND ConvertedCompYearly <= hi)",
    "m AS (SELECT quantile_disc(YearsCodeProNum, 0.5) AS my, quantile_disc(AgeNum, 0.5) AS ma FROM t)",
    f"""silver AS (SELECT ResponseId, SurveyYear, ConvertedCompYearly, CompTotal, Country,
      {rare_sql('Country', RARE_MIN)} AS CountryGrouped,
      MainBranch, Employment, DevType, YearsCodePro, YearsCodeProNum,
      COALESCE(YearsCodeProNum, my) AS YearsCodeProNum_imp, Age, AgeNum, COALESCE(AgeNum, ma) AS AgeNum_imp,
      EdLevel, OrgSize, RemoteWork,
      COALESCE(LanguageHaveWorkedWith, 'None') AS LanguageHaveWorkedWith,
      COALESCE(DatabaseHaveWorkedWith, 'None') AS DatabaseHaveWorkedWith
    FROM t, m)""",
]

USABLE = f"u AS (SELECT * FROM survey WHERE {POSITIVE})"


def _batches(drop_mid_priority: bool) -> str:
    cols = "o_orderkey, o_custkey, o_totalprice, o_orderdate"
    parts = [
        ("early", "year(o_orderdate) <= 1996", True),
        ("mid", "year(o_orderdate) BETWEEN 1997 AND 1998", not drop_mid_priority),
        ("late", "(year(o_orderdate) >= 1999 OR o_orderdate IS NULL)", True),
    ]
    sel = []
    for tag, cond, with_prio in parts:
        extra = ", o_orderpriority" if with_prio else ""
        sel.append(f"SELECT {cols}{extra}, '{tag}' AS batch FROM orders WHERE {cond}")
    joiner = "\nUNION ALL BY NAME\n" if drop_mid_priority else "\nUNION ALL\n"
    return joiner.join(sel)


def _missing_sql() -> str:
    cols = [
        "ResponseId", "SurveyYear", "Country", "ConvertedCompYearly", "CompTotal", "MainBranch",
        "Employment", "DevType", "YearsCodePro", "Age", "EdLevel", "OrgSize", "RemoteWork",
        "LanguageHaveWorkedWith", "DatabaseHaveWorkedWith",
    ]
    parts = [
        f"SELECT '{c}' AS col, count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) AS total FROM u" for c in cols
    ]
    body = (
        "SELECT col, missing, round(missing / greatest(total, 1) * 100.0, 6) AS missing_pct FROM ("
        + " UNION ALL ".join(parts)
        + ") ORDER BY missing_pct DESC, col LIMIT 20"
    )
    return with_ctes(SURVEY_CTE, USABLE, body=body)


def _quartiles_sql() -> str:
    ctes = [SURVEY_CTE, USABLE]
    selects = []
    for col, top_n, min_n in QUARTILE_DIMS:
        ctes.append(
            f"s_{col} AS (SELECT {col} AS value, count(*) AS n FROM u GROUP BY {col} HAVING count(*) >= {min_n} "
            f"ORDER BY n DESC, value ASC NULLS FIRST LIMIT {top_n})"
        )
        ctes.append(
            f"q_{col} AS (SELECT {col} AS value, quantile_disc(ConvertedCompYearly, 0.25) AS p25, "
            f"quantile_disc(ConvertedCompYearly, 0.5) AS median_salary, "
            f"quantile_disc(ConvertedCompYearly, 0.75) AS p75 FROM u GROUP BY {col})"
        )
        selects.append(
            f"SELECT '{col}' AS dimension, s.value, s.n, q.p25, q.median_salary, q.p75, "
            f"q.median_salary - q.p25 AS err_low, q.p75 - q.median_salary AS err_high "
            f"FROM s_{col} s JOIN q_{col} q ON s.value IS NOT DISTINCT FROM q.value"
        )
    return with_ctes(*ctes, body="\nUNION ALL\n".join(selects))


def _hist_sql(value_expr: str) -> str:
    return with_ctes(
        "b AS (SELECT quantile_disc(o_totalprice, 0.99) AS q99 FROM orders)",
        f"k AS (SELECT {value_expr} AS x FROM orders, b "
        "WHERE o_totalprice IS NOT NULL AND o_totalprice > 0 AND o_totalprice <= q99)",
        "r AS (SELECT min(x) AS lo, max(x) AS hi FROM k)",
        body=_bins_body("k"),
    )


def _bins_body(src: str, bins: int = 60, ends: str = "r") -> str:
    return (
        f"SELECT bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS lo, "
        f"round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) AS hi, n FROM ("
        f"SELECT least(CAST(floor((x - lo) * CAST({bins} AS DOUBLE) / (hi - lo)) AS INTEGER), {bins - 1}) AS bin, "
        f"count(*) AS n FROM {src}, {ends} GROUP BY 1), {ends}"
    )


def _corr_sql() -> str:
    cols = CORR_COLS
    aggs, rows = [], []
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            aggs.append(f"corr({cols[i]}, {cols[j]}) AS c{i}_{j}")
            rows.append(f"SELECT '{cols[i]}' AS a, '{cols[j]}' AS b, round(c{i}_{j}, 6) AS corr FROM c")
            if i != j:
                rows.append(f"SELECT '{cols[j]}' AS a, '{cols[i]}' AS b, round(c{i}_{j}, 6) AS corr FROM c")
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return with_ctes(f"c AS (SELECT {', '.join(aggs)} FROM lineitem WHERE {notnull})", body=" UNION ALL ".join(rows))


def _index_ctes(col: str) -> list[str]:
    return [
        f"lc_{col} AS (SELECT {col} AS v, count(*) AS c FROM survey WHERE {col} IS NOT NULL GROUP BY {col})",
        f"li_{col} AS (SELECT v, CAST(row_number() OVER (ORDER BY c DESC, v) - 1 AS DOUBLE) AS idx FROM lc_{col})",
        f"ln_{col} AS (SELECT CAST(count(*) AS DOUBLE) AS nl FROM lc_{col})",
    ]


def _lr_ctes(reg: float, alpha: float, split: bool, sfx: str = "") -> list[str]:
    """Closed-form one-feature elastic net as MLlib fits it (standardised
    feature and label, population std): the CTE chain ends in ``coef``."""
    where = f"WHERE {md5_bucket_sql('l_orderkey')} < 80" if split else ""
    return [
        f"d{sfx} AS (SELECT l_orderkey, l_quantity AS x, ln(1 + l_extendedprice) AS y, "
        f"{md5_bucket_sql('l_orderkey')} AS bucket FROM lineitem)",
        f"s{sfx} AS (SELECT avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(y) AS sy, corr(x, y) AS r "
        f"FROM d{sfx} {where})",
        f"w{sfx} AS (SELECT *, CAST({reg} AS DOUBLE) / sy AS q FROM s{sfx})",
        f"c{sfx} AS (SELECT *, sign(r) * greatest(abs(r) - q * {alpha}, 0) / (1 + q * (1 - {alpha})) * sy / sx AS slope "
        f"FROM w{sfx})",
        f"coef{sfx} AS (SELECT my - slope * mx AS intercept, slope FROM c{sfx})",
    ]


def _lr_coef_sql(reg: float, alpha: float) -> str:
    return with_ctes(
        *_lr_ctes(reg, alpha, False), body="SELECT round(intercept, 6) AS intercept, round(slope, 6) AS slope FROM coef"
    )


def _pred_cte() -> str:
    return "p AS (SELECT y AS label, intercept + slope * x AS prediction FROM d, coef WHERE bucket >= 80)"


def _metrics_cols(src: str = "p") -> str:
    return (
        "count(*) AS n, sqrt(avg((label - prediction) * (label - prediction))) AS rmse_log, "
        "1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(label)) AS r2_log, "
        "avg(abs((exp(label) - 1) - (exp(prediction) - 1))) AS mae, "
        "sqrt(avg(((exp(label) - 1) - (exp(prediction) - 1)) * ((exp(label) - 1) - (exp(prediction) - 1)))) AS rmse, "
        f"count(*) FILTER (WHERE exp(prediction) - 1 = CAST('inf' AS DOUBLE)) AS n_infinite FROM {src}"
    )


def _metrics_sql() -> str:
    return with_ctes(
        *_lr_ctes(0.05, 0.0, True),
        _pred_cte(),
        f"mt AS (SELECT {_metrics_cols()})",
        body="SELECT n, round(rmse_log, 6) AS rmse_log, round(r2_log, 6) AS r2_log, round(mae, 2) AS mae, "
        "round(rmse, 2) AS rmse, n_infinite FROM mt",
    )


def _best_sql() -> str:
    ctes = []
    for name, reg, alpha in (("lr_ridge", 0.05, 0.0), ("lr_enet", 0.01, 0.5)):
        sfx = "_" + name
        ctes += _lr_ctes(reg, alpha, True, sfx)
        ctes.append(
            f"p{sfx} AS (SELECT y AS label, intercept + slope * x AS prediction FROM d{sfx}, coef{sfx} WHERE bucket >= 80)"
        )
        ctes.append(f"m{sfx} AS (SELECT '{name}' AS model, {_metrics_cols('p' + sfx)})")
    body = (
        "SELECT model, round(rmse_log, 6) AS rmse_log FROM (SELECT * FROM m_lr_ridge UNION ALL SELECT * FROM m_lr_enet) "
        "ORDER BY rmse_log ASC, model ASC LIMIT 1"
    )
    return with_ctes(*ctes, body=body)


def _diag_sql() -> str:
    return with_ctes(
        *_lr_ctes(0.05, 0.0, True),
        _pred_cte(),
        "k AS (SELECT label - prediction AS x FROM p)",
        "r AS (SELECT min(x) AS lo, max(x) AS hi FROM k)",
        body=_bins_body("k"),
    )


def _token_counts_sql() -> str:
    cols = ["LanguageHaveWorkedWith", "DatabaseHaveWorkedWith"]
    f = " UNION ALL ".join(
        f"SELECT ResponseId, '{c}' AS field, {tokens_sql(f'COALESCE({c}, ' + chr(39) + 'None' + chr(39) + ')')} AS toks FROM survey"
        for c in cols
    )
    return with_ctes(
        SURVEY_CTE,
        f"f AS ({f})",
        "nd AS (SELECT field, count(*) AS n_docs FROM f GROUP BY field)",
        "e AS (SELECT ResponseId, field, unnest(toks) AS token FROM f)",
        "st AS (SELECT field, token, count(*) AS tf, count(DISTINCT ResponseId) AS df FROM e GROUP BY field, token)",
        "k AS (SELECT st.* FROM st JOIN nd USING (field) WHERE df >= CAST(0.01 AS DOUBLE) * n_docs)",
        "r AS (SELECT field, token, tf, df, row_number() OVER (PARTITION BY field ORDER BY tf DESC, token) - 1 AS rank FROM k)",
        body="SELECT field, token, tf, df, CAST(rank AS INTEGER) AS rank FROM r WHERE rank < 30",
    )


def _report_sql() -> str:
    u = "u2 AS (SELECT * FROM silver WHERE ConvertedCompYearly IS NOT NULL AND ConvertedCompYearly > 0)"
    body = (
        "SELECT 'usable_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM u2 UNION ALL "
        "SELECT 'salary_q01', quantile_disc(ConvertedCompYearly, 0.01) FROM u2 UNION ALL "
        "SELECT 'salary_median', quantile_disc(ConvertedCompYearly, 0.5) FROM u2 UNION ALL "
        "SELECT 'salary_q99', quantile_disc(ConvertedCompYearly, 0.99) FROM u2"
    )
    return with_ctes(*SILVER_CTES, u, body=body)


def _profile_sql(group: bool) -> str:
    g = "SurveyYear, " if group else ""
    tail = " GROUP BY SurveyYear" if group else ""
    return with_ctes(
        SURVEY_CTE,
        body=(
            f"SELECT {g}count(*) AS n_rows, count(ConvertedCompYearly) AS n_salary_not_null, "
            "count(*) FILTER (WHERE ConvertedCompYearly IS NULL) AS n_salary_null, "
            "round(avg(ConvertedCompYearly), 6) AS mean_salary, "
            f"quantile_disc(ConvertedCompYearly, 0.5) AS median_salary FROM survey{tail}"
        ),
    )


def _landing_sql() -> str:
    present = {
        "ResponseId": "CAST(ResponseId AS VARCHAR)",
        "Country": "Country",
        "Age": "Age",
        "Employment": "Employment",
        "EdLevel": "EdLevel",
        "YearsCodePro": "YearsCodePro",
        "DevType": "DevType",
        "OrgSize": "OrgSize",
        "LanguageHaveWorkedWith": "LanguageHaveWorkedWith",
        "DatabaseHaveWorkedWith": "DatabaseHaveWorkedWith",
        "MainBranch": "MainBranch",
        "RemoteWork": "RemoteWork",
        "ConvertedCompYearly": "ConvertedCompYearly",
        "CompTotal": "CompTotal",
        "SurveyYear": "SurveyYear",
    }
    sql_type = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER"}
    cols = []
    for f in SURVEY_SCHEMA.fields:
        expr = present.get(f.name, f"CAST(NULL AS {sql_type[f.dataType.simpleString()]})")
        cols.append(f"{expr} AS {f.name}")
    return with_ctes(SURVEY_CTE, body="SELECT " + ", ".join(cols) + " FROM survey")


def _trained_sql(*models: tuple[str, bool]) -> str:
    """Test rows and label statistics of (model name, trimmed) on the silver rows' hash split."""
    bucket = "(('0x' || substr(md5(concat_ws('|', CAST(SurveyYear AS VARCHAR), CAST(ResponseId AS VARCHAR))), 1, 8))::BIGINT % 100)"
    ctes = [
        *SILVER_CTES,
        f"g AS (SELECT ConvertedCompYearly AS pay, ln(1 + ConvertedCompYearly) AS label, {bucket} AS bucket FROM silver WHERE {POSITIVE})",
        "gb AS (SELECT quantile_disc(pay, 0.01) AS lo, quantile_disc(pay, 0.99) AS hi FROM g)",
    ]
    rows = [
        f"SELECT '{name}' AS model, count(*) AS n, round(avg(label), 6) AS label_mean, round(stddev_samp(label), 6) AS label_std, "
        f"TRUE AS all_finite, TRUE AS beats_mean, TRUE AS follows, TRUE AS agrees, TRUE AS metrics_agree FROM g{', gb' if trimmed else ''} WHERE bucket >= 80{' AND pay BETWEEN lo AND hi' if trimmed else ''}"
        for name, trimmed in models
    ]
    return with_ctes(*ctes, body=" UNION ALL ".join(rows))


def _gold_sql() -> str:
    """The gold vectors in long form: one-hot slots by label frequency, token counts by vocabulary rank,
    the numeric column; each divided by its slot's sample deviation over all rows."""
    cats = ["CountryGrouped", "EdLevel", "OrgSize", "RemoteWork"]
    texts = ["LanguageHaveWorkedWith", "DatabaseHaveWorkedWith"]
    fill = ", ".join(f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'None' ELSE {c} END AS {c}" for c in texts)
    ctes = [*SILVER_CTES, f"g AS (SELECT SurveyYear, ResponseId, {', '.join(cats)}, {fill}, YearsCodeProNum_imp FROM silver WHERE {POSITIVE})"]
    entries, sizes = [], []
    for block, c in enumerate(cats):
        ctes.append(f"l{block} AS (SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS idx FROM g WHERE {c} IS NOT NULL GROUP BY {c})")
        entries.append(f"SELECT SurveyYear, ResponseId, {block} AS block, coalesce(idx, (SELECT count(*) FROM l{block})) AS idx, 1.0::DOUBLE AS x FROM g LEFT JOIN l{block} ON {c} = v")
        sizes.append(f"SELECT {block} AS block, count(*) + 1 AS size FROM l{block}")
    for block, c in enumerate(texts, len(cats)):
        ctes.append(f"t{block} AS (SELECT SurveyYear, ResponseId, t, count(*) AS n FROM (SELECT SurveyYear, ResponseId, unnest({tokens_sql(c)}) AS t FROM g) GROUP BY ALL)")
        ctes.append(
            f"l{block} AS (SELECT t AS v, row_number() OVER (ORDER BY sum(n) DESC, t) - 1 AS idx FROM t{block} GROUP BY t "
            f"HAVING count(*) >= 0.01 * (SELECT count(*) FROM g) QUALIFY idx < 30)"
        )
        entries.append(f"SELECT SurveyYear, ResponseId, {block} AS block, idx, n::DOUBLE AS x FROM t{block} JOIN l{block} ON t = v")
        sizes.append(f"SELECT {block} AS block, greatest(count(*), 1) AS size FROM l{block}")
    last = len(cats) + len(texts)
    entries.append(f"SELECT SurveyYear, ResponseId, {last} AS block, 0 AS idx, YearsCodeProNum_imp AS x FROM g")
    sizes.append(f"SELECT {last} AS block, 1 AS size")
    ctes += [
        f"sizes AS ({' UNION ALL '.join(sizes)})",
        "begins AS (SELECT block, coalesce(sum(size) OVER (ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin FROM sizes)",
        f"e AS (SELECT SurveyYear, ResponseId, CAST(begin + idx AS INTEGER) AS slot, x FROM ({' UNION ALL '.join(entries)}) JOIN begins USING (block))",
        "n AS (SELECT count(*)::DOUBLE AS n FROM g)",
        "s AS (SELECT slot, sqrt((sum(x * x) - sum(x) * sum(x) / any_value(n)) / (any_value(n) - 1)) AS sd FROM e, n GROUP BY slot)",
    ]
    return with_ctes(*ctes, body="SELECT SurveyYear, ResponseId, slot, round(x * (1 / sd), 6) AS value FROM e JOIN s USING (slot) WHERE x <> 0 AND sd > 1e-9")


def _scatter_sql(bins: int = 40) -> str:
    cell = lambda x, lo, hi: f"least(CAST(floor(({x} - {lo}) * {float(bins)} / ({hi} - {lo})) AS INTEGER), {bins - 1})"
    low = lambda b, lo, hi: f"round({lo} + {b} * (({hi} - {lo}) / {bins}), 6)"
    return with_ctes(
        "r AS (SELECT min(l_quantity)::DOUBLE x0, max(l_quantity)::DOUBLE x1, min(l_extendedprice)::DOUBLE y0, max(l_extendedprice)::DOUBLE y1 FROM lineitem)",
        f"c AS (SELECT {cell('l_quantity', 'x0', 'x1')} AS x_bin, {cell('l_extendedprice', 'y0', 'y1')} AS y_bin, x0, x1, y0, y1 FROM lineitem, r)",
        body=f"SELECT x_bin, y_bin, {low('x_bin', 'x0', 'x1')} AS x_lo, {low('y_bin', 'y0', 'y1')} AS y_lo, count(*) AS n FROM c GROUP BY x_bin, y_bin, x0, x1, y0, y1",
    )


def _split_keys_sql() -> str:
    text = "concat_ws('|', coalesce(CAST(k AS VARCHAR), '\\N'), coalesce(o_orderstatus, '\\N'))"
    return (
        f"SELECT *, CASE WHEN ('0x' || substr(md5({text}), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS split "
        "FROM (SELECT o_orderkey, nullif(o_orderkey % 97, 0) AS k, o_orderstatus FROM orders)"
    )


def _scatter_diag_sql(bins: int = 60) -> str:
    """Cells of (label, prediction) and of their money values, predictions clipped to the labels' 1-99 % range."""
    cell = lambda x, lo, hi: f"least(CAST(floor(({x} - {lo}) * CAST({bins} AS DOUBLE) / ({hi} - {lo})) AS INTEGER), {bins - 1})"
    low = lambda b, lo, hi: f"round({lo} + {b} * (({hi} - {lo}) / {bins}), 6)"
    return with_ctes(
        *_lr_ctes(0.05, 0.0, True),
        _pred_cte(),
        "qb AS (SELECT quantile_disc(label, 0.01) AS q01, quantile_disc(label, 0.99) AS q99 FROM p)",
        "xy AS (SELECT 'scatter_log' AS chart, label AS x, prediction AS y FROM p UNION ALL "
        "SELECT 'scatter_real', exp(label) - 1, exp(greatest(q01, least(prediction, q99))) - 1 FROM p, qb)",
        "ends AS (SELECT chart, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM xy GROUP BY chart)",
        f"cells AS (SELECT chart, {cell('x', 'x0', 'x1')} AS x_bin, {cell('y', 'y0', 'y1')} AS y_bin, x0, x1, y0, y1 FROM xy JOIN ends USING (chart))",
        body=f"SELECT chart, x_bin, y_bin, {low('x_bin', 'x0', 'x1')} AS x_lo, {low('y_bin', 'y0', 'y1')} AS y_lo, count(*) AS n "
        "FROM cells GROUP BY chart, x_bin, y_bin, x0, x1, y0, y1",
    )


def _charts_sql(bins: int = 60) -> str:
    """All EDA tables over the silver rows in long form."""
    pay = "ConvertedCompYearly"
    corr = ["AgeNum_imp", "YearsCodeProNum_imp", "CompTotal", pay]
    missing = " UNION ALL ".join(f"SELECT '{c}' AS col, count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) AS total FROM u" for c in SILVER_COLUMNS)
    pairs = " UNION ALL ".join(f"SELECT '{x}' AS x, '{y}' AS y, corr({x}, {y}) AS corr FROM complete" for x in corr for y in corr)
    quartiles = " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS dimension, {c} AS value, count(*) AS n, quantile_disc({pay}, 0.25) AS p25, quantile_disc({pay}, 0.5) AS median_salary, "
        f"quantile_disc({pay}, 0.75) AS p75 FROM u GROUP BY {c} HAVING count(*) >= {least} ORDER BY n DESC, value NULLS FIRST LIMIT {top})"
        for c, top, least in QUARTILE_DIMS
    )
    cell = lambda v: f"least(CAST(floor(({v} - {v}0) * CAST({bins} AS DOUBLE) / ({v}1 - {v}0)) AS INTEGER), {bins - 1})"
    low = lambda v: f"{v}0 + {v}_bin * (({v}1 - {v}0) / {bins})"
    ctes = [
        *SILVER_CTES,
        f"u AS (SELECT * FROM silver WHERE {POSITIVE})",
        f"missing AS (SELECT col, missing, missing / greatest(total, 1) * 100.0 AS missing_pct FROM ({missing}) ORDER BY missing_pct DESC, col LIMIT 20)",
        f"h AS (SELECT {pay} AS x, ln(1 + {pay}) AS lx FROM u WHERE {pay} <= (SELECT quantile_disc({pay}, 0.99) FROM u))",
        "raw AS (SELECT x FROM h)",
        "raw_ends AS (SELECT min(x) AS lo, max(x) AS hi FROM raw)",
        "logs AS (SELECT lx AS x FROM h)",
        "log_ends AS (SELECT min(x) AS lo, max(x) AS hi FROM logs)",
        f"hist_raw AS ({_bins_body('raw', bins, 'raw_ends')})",
        f"hist_log AS ({_bins_body('logs', bins, 'log_ends')})",
        "countries AS (SELECT CountryGrouped, count(*) AS n FROM u GROUP BY CountryGrouped ORDER BY n DESC, CountryGrouped NULLS FIRST LIMIT 15)",
        f"complete AS (SELECT * FROM u WHERE {' AND '.join(f'{c} IS NOT NULL' for c in corr)})",
        f"corrs AS ({pairs})",
        f"trends AS (SELECT SurveyYear, count(*) AS n, quantile_disc({pay}, 0.5) AS median_salary FROM u GROUP BY SurveyYear)",
        f"rep AS (SELECT unnest(['usable_rows', 'salary_q01', 'salary_median', 'salary_q99']) AS metric, unnest([CAST(count(*) AS DOUBLE), "
        f"quantile_disc({pay}, 0.01), quantile_disc({pay}, 0.5), quantile_disc({pay}, 0.99)]) AS value FROM u)",
        f"quartiles AS (SELECT *, median_salary - p25 AS err_low, p75 - median_salary AS err_high FROM ({quartiles}))",
        f"xy AS (SELECT YearsCodeProNum_imp AS x, ln(1 + {pay}) AS y FROM u WHERE YearsCodeProNum_imp IS NOT NULL)",
        "xy_ends AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM xy)",
        f"cells AS (SELECT {cell('x')} AS x_bin, {cell('y')} AS y_bin, x0, x1, y0, y1 FROM xy, xy_ends)",
        f"scatter AS (SELECT x_bin, y_bin, {low('x')} AS x_lo, {low('y')} AS y_lo, count(*) AS n FROM cells GROUP BY x_bin, y_bin, x0, x1, y0, y1)",
    ]
    charts = [
        ("missing_top20", "missing", "col", "NULL", ["missing", "missing_pct"]),
        ("salary_hist_raw", "hist_raw", "bin", "NULL", ["lo", "hi", "n"]),
        ("salary_hist_log", "hist_log", "bin", "NULL", ["lo", "hi", "n"]),
        ("top_countries", "countries", "CountryGrouped", "NULL", ["n"]),
        ("corr", "corrs", "x", "y", ["corr"]),
        ("trend", "trends", "SurveyYear", "NULL", ["n", "median_salary"]),
        ("report", "rep", "metric", "NULL", ["value"]),
        ("quartiles", "quartiles", "dimension", "value", ["n", "p25", "median_salary", "p75", "err_low", "err_high"]),
        ("scatter_years_pro", "scatter", "x_bin", "y_bin", ["x_lo", "y_lo", "n"]),
    ]
    rows = [
        f"SELECT '{chart}' AS chart, CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b, '{m}' AS measure, round(CAST({m} AS DOUBLE), 6) AS value FROM {src}"
        for chart, src, a, b, measures in charts
        for m in measures
    ]
    return with_ctes(*ctes, body="\nUNION ALL\n".join(rows))


ORACLE: dict[str, str] = {
    "survey_base": with_ctes(SURVEY_CTE, body="SELECT * FROM survey"),
    "union_strict": _batches(False),
    "union_null_fill": _batches(True),
    "tolerant_select": with_ctes(SURVEY_CTE, body="SELECT ResponseId, Country, Age, EdLevel FROM survey"),
    "safe_cast": with_ctes(
        SURVEY_CTE,
        body="SELECT ResponseId, YearsCodePro, TRY_CAST(YearsCodePro AS DOUBLE) AS YearsCodePro_double FROM survey",
    ),
    "pop_filter": with_ctes(
        SURVEY_CTE, body=f"SELECT ResponseId, Country, ConvertedCompYearly FROM survey WHERE {POP_WHERE}"
    ),
    "positive_filter": with_ctes(
        SURVEY_CTE, body=f"SELECT ResponseId, ConvertedCompYearly FROM survey WHERE {POSITIVE}"
    ),
    "trim_outliers": with_ctes(
        SURVEY_CTE,
        f"pop AS (SELECT * FROM survey WHERE {POP_WHERE})",
        "b AS (SELECT quantile_disc(ConvertedCompYearly, 0.01) AS lo, quantile_disc(ConvertedCompYearly, 0.99) AS hi FROM pop)",
        body="SELECT ResponseId, ConvertedCompYearly FROM pop, b WHERE ConvertedCompYearly >= lo AND ConvertedCompYearly <= hi",
    ),
    "upper_cut": with_ctes(
        "b AS (SELECT quantile_disc(o_totalprice, 0.99) AS hi FROM orders)",
        body="SELECT o_orderkey, o_totalprice FROM orders, b WHERE o_totalprice <= hi",
    ),
    "drop_any_null": with_ctes(
        SURVEY_CTE,
        body="SELECT ResponseId, YearsCodePro, Age, RemoteWork FROM survey "
        "WHERE YearsCodePro IS NOT NULL AND Age IS NOT NULL AND RemoteWork IS NOT NULL",
    ),
    "parse_years": with_ctes(
        SURVEY_CTE, body=f"SELECT ResponseId, YearsCodePro, {years_sql('YearsCodePro')} AS YearsCodeProNum FROM survey"
    ),
    "parse_age": with_ctes(SURVEY_CTE, body=f"SELECT ResponseId, Age, {age_sql('Age')} AS AgeNum FROM survey"),
    "group_rare": with_ctes(
        SURVEY_CTE,
        f"pop AS (SELECT * FROM survey WHERE {POP_WHERE})",
        body=f"SELECT ResponseId, Country, {rare_sql('Country', RARE_MIN)} AS CountryGrouped FROM pop",
    ),
    "impute_median": with_ctes(
        SURVEY_CTE,
        f"p AS (SELECT ResponseId, {years_sql('YearsCodePro')} AS YearsCodeProNum, {age_sql('Age')} AS AgeNum FROM survey)",
        body="SELECT ResponseId, YearsCodeProNum, AgeNum, "
        "COALESCE(YearsCodeProNum, (SELECT quantile_disc(YearsCodeProNum, 0.5) FROM p)) AS YearsCodeProNum_imp, "
        "COALESCE(AgeNum, (SELECT quantile_disc(AgeNum, 0.5) FROM p)) AS AgeNum_imp FROM p",
    ),
    "fill_text": with_ctes(
        SURVEY_CTE,
        body="SELECT ResponseId, COALESCE(LanguageHaveWorkedWith, 'None') AS LanguageHaveWorkedWith, "
        "COALESCE(DatabaseHaveWorkedWith, 'None') AS DatabaseHaveWorkedWith FROM survey",
    ),
    "silver_full": with_ctes(*SILVER_CTES, body="SELECT * FROM silver"),
    "profile_year": _profile_sql(True),
    "profile_table": _profile_sql(False),
    "missing_rates": _missing_sql(),
    "group_quartiles": _quartiles_sql(),
    "top_groups": with_ctes(
        SURVEY_CTE, USABLE, body="SELECT Country, count(*) AS n FROM u GROUP BY Country "
        "ORDER BY n DESC, Country ASC NULLS FIRST LIMIT 15"
    ),
    "salary_trend": with_ctes(
        SURVEY_CTE,
        USABLE,
        body="SELECT SurveyYear, count(*) AS n, quantile_disc(ConvertedCompYearly, 0.5) AS median_salary "
        "FROM u GROUP BY SurveyYear",
    ),
    "salary_quantiles": "SELECT quantile_disc(l_extendedprice, 0.01) AS q01, quantile_disc(l_extendedprice, 0.5) AS median, "
    "quantile_disc(l_extendedprice, 0.99) AS q99 FROM lineitem",
    "hist_raw": _hist_sql("o_totalprice"),
    "hist_log": _hist_sql("ln(1 + o_totalprice)"),
    "corr_matrix": _corr_sql(),
    "hash_sample": f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT {SAMPLE_N}",
    "hash_split": f"SELECT o_orderkey, CASE WHEN {md5_bucket_sql('o_orderkey')} < 80 THEN 'train' ELSE 'test' END AS split FROM orders",
    "index_labels": with_ctes(
        SURVEY_CTE,
        *_index_ctes("Country"),
        *_index_ctes("OrgSize"),
        body="SELECT s.ResponseId, s.Country, s.OrgSize, "
        "COALESCE(a.idx, (SELECT nl FROM ln_Country)) AS Country_idx, "
        "COALESCE(b.idx, (SELECT nl FROM ln_OrgSize)) AS OrgSize_idx "
        "FROM survey s LEFT JOIN li_Country a ON s.Country = a.v LEFT JOIN li_OrgSize b ON s.OrgSize = b.v",
    ),
    "one_hot": with_ctes(
        SURVEY_CTE,
        *_index_ctes("OrgSize"),
        body="SELECT s.ResponseId, s.OrgSize, CAST((SELECT nl FROM ln_OrgSize) + 1 AS INTEGER) AS vec_size, "
        "CAST(COALESCE(b.idx, (SELECT nl FROM ln_OrgSize)) AS INTEGER) AS hot_slot, CAST(1.0 AS DOUBLE) AS vec_sum "
        "FROM survey s LEFT JOIN li_OrgSize b ON s.OrgSize = b.v",
    ),
    "tokens": with_ctes(
        SURVEY_CTE,
        "f AS (SELECT ResponseId, COALESCE(LanguageHaveWorkedWith, 'None') AS l, "
        "COALESCE(DatabaseHaveWorkedWith, 'None') AS d FROM survey)",
        body=f"SELECT ResponseId, array_to_string({tokens_sql('l')}, '|') AS lang_tokens, "
        f"CAST(len({tokens_sql('l')}) AS INTEGER) AS n_lang, array_to_string({tokens_sql('d')}, '|') AS db_tokens, "
        f"CAST(len({tokens_sql('d')}) AS INTEGER) AS n_db FROM f",
    ),
    "token_counts": _token_counts_sql(),
    "assemble_scale": with_ctes(
        "s AS (SELECT stddev_samp(l_quantity) AS s0, stddev_samp(l_extendedprice) AS s1, "
        "stddev_samp(l_discount) AS s2 FROM lineitem)",
        body="SELECT l_orderkey, l_linenumber, round(l_quantity * (1 / s0), 6) AS f0, "
        "round(l_extendedprice * (1 / s1), 6) AS f1, round(l_discount * (1 / s2), 6) AS f2 FROM lineitem, s",
    ),
    "lr_ridge_1f": _lr_coef_sql(0.05, 0.0),
    "lr_enet_1f": _lr_coef_sql(0.01, 0.5),
    "metrics_from_predictions": _metrics_sql(),
    "best_model": _best_sql(),
    "diagnostics_lr": _diag_sql(),
    "run_report": _report_sql(),
    "stream_landing": _landing_sql(),
    "features_gold": _gold_sql(),
    "train_lr_full": _trained_sql(("lr_v1", False), ("lr_v2", True)),
    "train_v1": _trained_sql(("lr_v1", False), ("gbt_v1", False)),
    "train_v2": _trained_sql(("lr_v2", True), ("gbt_v2", True)),
    "batch_score": with_ctes(*SILVER_CTES, body="SELECT SurveyYear, ResponseId, TRUE AS lr_pred_log, TRUE AS lr_salary_pred, TRUE AS gbt_pred_log, "
        f"TRUE AS gbt_salary_pred FROM silver WHERE {POSITIVE}"),
    "score_features": with_ctes(
        *SILVER_CTES, body=f"SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differ FROM silver WHERE {POSITIVE}"
    ),
    "index_many": "SELECT l_orderkey, l_linenumber, l_partkey, CAST(idx AS DOUBLE) AS l_partkey_idx FROM lineitem JOIN (SELECT l_partkey, "
    "row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS idx FROM lineitem GROUP BY l_partkey) USING (l_partkey)",
    "csv_splits": with_ctes(SURVEY_CTE, body=f"SELECT ResponseId, {CSV_NOTE} AS note, Age, EdLevel FROM survey"),
    "profile_growing": _profile_sql(True),
    "trend_growing": with_ctes(
        SURVEY_CTE,
        USABLE,
        body="SELECT SurveyYear, count(*) AS n, quantile_disc(ConvertedCompYearly, 0.5) AS median_salary FROM u GROUP BY SurveyYear",
    ),
    "diagnostics_scatter": _scatter_diag_sql(),
    "eda_charts": _charts_sql(),
    "jobs_silver": with_ctes(*SILVER_CTES, body="SELECT *, CAST(0 AS BIGINT) AS surplus FROM silver"),
    "jobs_score": with_ctes(
        *SILVER_CTES,
        body="SELECT coalesce(EdLevel, '-') || '|' || coalesce(RemoteWork, '-') AS request, "
        + ", ".join(f"max({c}) AS {c}" for c in REQUEST_FIELDS)
        + f", TRUE AS agrees FROM silver WHERE {POSITIVE} GROUP BY EdLevel, RemoteWork",
    ),
    "scatter_bins": _scatter_sql(),
    "hash_split_keys": _split_keys_sql(),
    "bronze_two_years": with_ctes(SURVEY_CTE, body="SELECT * FROM survey WHERE SurveyYear IN (1996, 1997)"),
}
