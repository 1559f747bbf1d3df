"""The queries as SQL over the same tables, written on their own."""

from __future__ import annotations

RECIPE = """
with o as (
  select o_custkey, min(o_orderdate) as f, max(o_orderdate) as l, count(*) as n,
         max(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as urg
  from orders group by o_custkey),
b as (
  select c.*, o.*, (year(l)*12 + month(l)) - (year(f)*12 + month(f)) as mths, c_nationkey % 3 as net
  from customer c join o on c_custkey = o_custkey),
d as (
  select *, cast(floor(greatest(0, mths - 36) * 7 / 4.0) as int) as tenure,
         1825 + cast(floor((c_acctbal + 1000) * 100 / 110) as bigint) as cents
  from b),
r as (
  select c_name as customerID,
    case when c_custkey % 2 = 0 then 'Male' else 'Female' end as gender,
    case when c_acctbal < 0 then 1 else 0 end as SeniorCitizen,
    case when c_custkey % 3 = 0 then 'yes' else 'No' end as Partner,
    case when n % 3 = 0 then 'Yes' else 'No' end as Dependents,
    tenure,
    case when urg = 1 then 'Yes' else 'No' end as PhoneService,
    case when urg = 0 then 'No phone service' when c_custkey % 2 = 0 then 'Yes' else 'No' end as MultipleLines,
    case when net = 0 then 'No' when net = 1 then 'DSL' else 'Fiber optic' end as InternetService,
    case when net = 0 then 'No internet service' when c_custkey % 7 < 2 then 'Yes' else 'No' end as OnlineSecurity,
    case when net = 0 then 'No internet service' when c_custkey % 7 < 3 then 'Yes' else 'No' end as OnlineBackup,
    case when net = 0 then 'No internet service' when c_custkey % 11 < 4 then 'Yes' else 'No' end as DeviceProtection,
    case when net = 0 then 'No internet service' when n % 2 = 0 then 'Yes' else 'No' end as TechSupport,
    case when net = 0 then 'No internet service' when c_custkey % 5 < 2 then 'Yes' else 'No' end as StreamingTV,
    case when net = 0 then 'No internet service' when c_custkey % 13 < 6 then 'Yes' else 'No' end as StreamingMovies,
    case when n <= 8 then 'Month-to-month' when n <= 12 then 'One year' else 'Two year' end as Contract,
    case when c_custkey % 17 < 10 then 'Yes' else 'No' end as PaperlessBilling,
    case c_mktsegment when 'AUTOMOBILE' then 'Electronic check' when 'BUILDING' then 'Mailed check'
      when 'FURNITURE' then 'Bank transfer (automatic)' when 'HOUSEHOLD' then 'Credit card (automatic)' end as PaymentMethod,
    cast(cents as double) / cast(100 as double) as MonthlyCharges,
    case when tenure = 0 then ' '
      else cast(cast(round(cast(tenure * cents as double) / cast(100 as double), 2) as decimal(18,2)) as varchar) end as TotalCharges,
    case when l < timestamp '2001-02-01' then 'Yes' else 'No' end as Churn,
    c_custkey % 50 as k
  from d),
u as (select * from r union all select * from r where k = 7)
select * exclude (k) from u
"""

COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService", "MultipleLines",
    "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn",
]
NUMBERS = ["SeniorCitizen", "tenure", "MonthlyCharges"]
TEXTS = [c for c in COLUMNS if c not in NUMBERS]
LINE_TYPES = {
    "l_orderkey": "n", "l_partkey": "n", "l_suppkey": "n", "l_linenumber": "n", "l_quantity": "n",
    "l_extendedprice": "n", "l_discount": "n", "l_tax": "n", "l_returnflag": "t", "l_linestatus": "t", "l_shipdate": "d",
}
MONEY = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def q(name: str) -> str:
    return '"' + name + '"'


def rnd(expression: str, digits: int = 6) -> str:
    unit = 10**digits
    return f"floor(cast({expression} as double) * {unit}.0::double + 0.5::double) / {unit}.0::double"


def union(parts) -> str:
    return " union all ".join(parts)


def interpolated(column: str, share: float, table: str) -> str:
    """A quantile whose interpolation is written out, so that its last bit is the same in all engines."""
    place = f"({share!r}::double * (n - 1))"
    low, high = f"v[floor({place})::bigint + 1]", f"v[ceil({place})::bigint + 1]"
    values = f"select list_sort(list({column}::double) filter ({column} is not null)) as v, count({column}) as n from {table}"
    return f"(select {low} + ({high} - {low}) * ({place} - floor({place})) from ({values}))"


# --- the customer table, step by step -----------------------------------------

CP = f"cp as ({RECIPE})"

TYPED = """typed as (select * replace (
    case SeniorCitizen when 0 then 'No' when 1 then 'Yes' end as SeniorCitizen,
    case when Partner = 'yes' then 'Yes' else Partner end as Partner,
    try_cast(nullif(TotalCharges, ' ') as double) as TotalCharges) from cp)"""

FILLED = f"""filled as (select * replace (
    coalesce(TotalCharges, {interpolated('TotalCharges', 0.5, 'typed')}) as TotalCharges,
    coalesce(PaymentMethod, (select PaymentMethod from typed where PaymentMethod is not null
        group by PaymentMethod order by count(*) desc, PaymentMethod limit 1)) as PaymentMethod) from typed),
dist as (select distinct * from filled)"""


def _limits(table: str, columns) -> str:
    parts = []
    for c in columns:
        parts.append(
            f"(select {{'lo': q1 - 1.5 * (q3 - q1), 'hi': q3 + 1.5 * (q3 - q1)}} from "
            f"(select {interpolated(c, 0.25, table)} as q1, {interpolated(c, 0.75, table)} as q3)) as l_{c}"
        )
    return f"limits as (select {', '.join(parts)})"


def _capped(c: str) -> str:
    return f"case when {c} < l_{c}.lo then l_{c}.lo when {c} > l_{c}.hi then l_{c}.hi else {c} end"


CAPPED = (
    _limits("dist", ["tenure", "MonthlyCharges", "TotalCharges"])
    + ", capped as (select dist.* replace ("
    + ", ".join(f"{_capped(c)} as {c}" for c in ["tenure", "MonthlyCharges", "TotalCharges"])
    + ") from dist, limits)"
)

BINARY = ["SeniorCitizen", "Partner", "Dependents", "PhoneService", "PaperlessBilling", "Churn"]
CATEGORIES = {
    "gender": ["Male"],
    "MultipleLines": ["No phone service", "Yes"],
    "InternetService": ["Fiber optic", "No"],
    **{
        c: ["No internet service", "Yes"]
        for c in ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"]
    },
    "Contract": ["One year", "Two year"],
    "PaymentMethod": ["Credit card (automatic)", "Electronic check", "Mailed check"],
}
DUMMIES = [f"{c}_{v}" for c, values in CATEGORIES.items() for v in values]
PLAIN = [c for c in COLUMNS if c not in CATEGORIES]
PREPARED_COLUMNS = PLAIN + DUMMIES


def _prepared() -> str:
    cells = []
    for c in PLAIN:
        cells.append(f"case when {c} = 'Yes' then 1 else 0 end as {c}" if c in BINARY else c)
    for c, values in CATEGORIES.items():
        cells += [f"case when {c} = '{v}' then 1 else 0 end as {q(f'{c}_{v}')}" for v in values]
    return f"prepared as (select {', '.join(cells)} from capped)"


PREPARED = f"{CP}, {TYPED}, {FILLED}, {CAPPED}, {_prepared()}"

TENURE_BINS = [("0-1_year", 0, 12), ("1-2_years", 12, 24), ("2-4_years", 24, 48), ("4-6_years", 48, 72), ("6+_years", 72, None)]
MONTHLY_BINS = [("Low", 0, 35), ("Medium", 35, 65), ("High", 65, 95), ("Very_High", 95, None)]
TOTAL_BINS = [("Low", 0, 1000), ("Medium", 1000, 3000), ("High", 3000, 6000), ("Very_High", 6000, None)]


def _test(value: str, low, high) -> str:
    return f"{value} > {low}" + (f" and {value} <= {high}" if high is not None else "")


def flags(value: str, bins, prefix: str) -> list[str]:
    return [f"case when {_test(value, lo, hi)} then 1 else 0 end as {q(f'{prefix}_{name}')}" for name, lo, hi in bins]


def group_label(value: str, bins) -> str:
    return "case " + " ".join(f"when {_test(value, lo, hi)} then '{name}'" for name, lo, hi in bins) + " end"


def safe_ratio(n: str, d: str) -> str:
    return f"case when {d} = 0 and {n} <> 0 then 0.0::double when {d} = 0 then null else {n}::double / {d}::double end"


SERVICES = ["PhoneService"] + [
    d for d in DUMMIES if d.split("_")[0] not in ("gender", "Contract", "PaymentMethod") and d != "MultipleLines_Yes"
]
PREMIUM = [d for d in SERVICES if d.split("_")[0] in ("OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies")]
TOTAL_SERVICES = " + ".join(q(s) for s in SERVICES)
CROSSED = [
    (f"Contract_{c}", f"PaymentMethod_{p}") for c in CATEGORIES["Contract"] for p in CATEGORIES["PaymentMethod"]
]


FEATURES = {
    "tenure_years": "tenure / 12.0::double",
    "tenure_squared": "tenure * tenure",
    "tenure_log": "ln(1 + tenure::double)",
    **{f"tenure_{n}": f"case when {_test('tenure', lo, hi)} then 1 else 0 end" for n, lo, hi in TENURE_BINS},
    "avg_monthly_charges": safe_ratio("TotalCharges", "tenure"),
    "total_to_monthly_ratio": safe_ratio("TotalCharges", "MonthlyCharges"),
    **{f"monthly_charges_{n}": f"case when {_test('MonthlyCharges', lo, hi)} then 1 else 0 end" for n, lo, hi in MONTHLY_BINS},
    **{f"total_charges_{n}": f"case when {_test('TotalCharges', lo, hi)} then 1 else 0 end" for n, lo, hi in TOTAL_BINS},
    "total_services": TOTAL_SERVICES,
    "service_density": safe_ratio(f"({TOTAL_SERVICES})", "MonthlyCharges"),
    "has_premium_services": f"case when {' + '.join(q(p) for p in PREMIUM)} > 0 then 1 else 0 end",
    "tenure_monthly_interaction": "tenure * MonthlyCharges",
    **{f"{a}_{b}_interaction": f"{q(a)} * {q(b)}" for a, b in CROSSED},
    "senior_service_interaction": f"SeniorCitizen * ({TOTAL_SERVICES})",
}
REAL = {
    "tenure", "MonthlyCharges", "TotalCharges", "tenure_years", "tenure_squared", "tenure_log", "avg_monthly_charges",
    "total_to_monthly_ratio", "service_density", "tenure_monthly_interaction",
}
FEATURED = (
    PREPARED + ", featured as (select *, " + ", ".join(f"{e} as {q(n)}" for n, e in FEATURES.items()) + " from prepared)"
)
FEATURED_COLUMNS = PREPARED_COLUMNS + list(FEATURES)
NUMERIC_FEATURES = [c for c in FEATURED_COLUMNS if c not in ("customerID", "Churn")]


def rounded_list(columns, digits: int = 6) -> str:
    return ", ".join(f"{rnd(q(c), digits)} as {q(c)}" if c in REAL else q(c) for c in columns)


def of_features(*columns) -> str:
    return f"with {FEATURED} select {rounded_list(columns)} from featured"


# --- checks -------------------------------------------------------------------


def missing(table: str, columns, digits: int = 6) -> str:
    return union(
        f"select '{c}' as column_name, count(*) filter ({c} is null) as missing_count, "
        f"{rnd(f'count(*) filter ({c} is null) * 100.0::double / count(*)', digits)} as missing_pct from {table}"
        for c in columns
    )


def rows_missing(table: str, columns, digits: int = 6) -> str:
    test = " or ".join(f"{c} is null" for c in columns)
    return (
        f"select count(*) as total_rows, count(*) filter ({test}) as rows_with_missing, "
        f"{rnd(f'count(*) filter ({test}) * 100.0::double / count(*)', digits)} as missing_rows_pct from {table}"
    )


def duplicates(table: str, columns, digits: int = 6) -> str:
    return (
        f"select cast(sum(n) as bigint) as total_rows, count(*) as distinct_rows, "
        f"cast(sum(n - 1) as bigint) as duplicate_rows, "
        f"{rnd('sum(n - 1)::double * 100.0::double / sum(n)::double', digits)} as duplicate_pct "
        f"from (select count(*) as n from {table} group by {', '.join(columns)})"
    )


def ranges(table: str, columns, digits: int) -> str:
    return union(
        f"select '{c}' as column_name, {rnd(f'min({c})', digits)} as min_value, {rnd(f'max({c})', digits)} as max_value, "
        f"{rnd(f'avg({c})', digits)} as mean_value, {rnd(f'stddev_samp({c})', digits)} as std_value, "
        f"{rnd(f'quantile_cont({c}::double, 0.5)', digits)} as median_value from {table}"
        for c in columns
    )


def share(table: str, columns, test: str, name: str, digits: int = 6) -> str:
    return union(
        f"select '{c}' as column_name, count(*) filter ({c} {test}) as {name}_count, "
        f"{rnd(f'count(*) filter ({c} {test}) * 100.0::double / count({c})', digits)} as {name}_pct from {table}"
        for c in columns
    )


def outliers(table: str, columns, digits: int = 6) -> str:
    return union(
        f"select '{c}' as column_name, count(*) filter ({c} < lo or {c} > hi) as outlier_count, "
        f"{rnd(f'count(*) filter ({c} < lo or {c} > hi) * 100.0::double / count({c})', digits)} as outlier_pct, "
        f"{rnd('any_value(q1)', digits)} as q1, {rnd('any_value(q3)', digits)} as q3, "
        f"{rnd('any_value(lo)', digits)} as lower_bound, {rnd('any_value(hi)', digits)} as upper_bound from {table}, "
        f"(select q1, q3, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from "
        f"(select quantile_cont({c}::double, 0.25) as q1, quantile_cont({c}::double, 0.75) as q3 from {table}))"
        for c in columns
    )


def counts(table: str, columns) -> str:
    return union(
        f"select '{c}' as column_name, {c} as value, count(*) as value_count from {table} where {c} is not null group by {c}"
        for c in columns
    )


def categories(table: str, columns) -> str:
    return f"""select column_name, count(*) as distinct_count,
        arg_min(value, rk) as most_frequent, max(value_count) as most_frequent_count,
        arg_max(value, rk) as least_frequent, min(value_count) as least_frequent_count
        from (select *, row_number() over (partition by column_name order by value_count desc, value) as rk
              from ({counts(table, columns)})) group by column_name"""


def cardinality(table: str, columns) -> str:
    return f"""select column_name, distinct_count,
        case when distinct_count > 0.5 * (select count(*) from {table}) then 'high'
             when distinct_count < 10 then 'low' else 'neither' end as cardinality
        from (select column_name, count(*) as distinct_count from ({counts(table, columns)}) group by column_name)"""


def measures(table: str, dataset: str, columns, numbers, texts, digits: int = 4) -> str:
    """All checks as (dataset, check, column_name, metric, value), unrounded counts included."""

    def melt(sql, check, metrics, column="column_name"):
        return union(
            f"""select '{dataset}' as dataset, '{check}' as "check", {column} as column_name, '{name}' as metric,
                cast({source} as double) as value from ({sql})"""
            for name, source in metrics.items()
        )

    def same(*names):
        return {n: n for n in names}

    parts = [
        melt(f"select count(*) as row_count, {len(columns)} as column_count from {table}", "shape", same("row_count", "column_count"), "''"),
        melt(missing(table, columns, digits), "missing", same("missing_count", "missing_pct")),
        melt(rows_missing(table, columns, digits), "missing", same("rows_with_missing", "missing_rows_pct"), "''"),
        melt(duplicates(table, columns, digits), "duplicates", same("duplicate_rows", "distinct_rows", "duplicate_pct"), "''"),
        melt(categories(table, texts), "categories", same("distinct_count", "most_frequent_count", "least_frequent_count")) if texts else None,
        melt(f"select * from ({cardinality(table, texts)}) where cardinality = 'high'", "categories", {"high_cardinality": "1"}) if texts else None,
        melt(constants(table, columns), "duplicates", {"constant": "1"}),
    ]
    if numbers:
        parts += [
            melt(ranges(table, numbers, digits), "ranges", same("min_value", "max_value", "mean_value", "std_value", "median_value")),
            melt(share(table, numbers, "< 0", "negative", digits), "ranges", same("negative_count", "negative_pct")),
            melt(share(table, numbers, "= 0", "zero", digits), "ranges", same("zero_count", "zero_pct")),
            melt(outliers(table, numbers, digits), "outliers", same("outlier_count", "outlier_pct", "lower_bound", "upper_bound")),
        ]
    return union(p for p in parts if p)


def constants(table: str, columns) -> str:
    return "select * from (" + union(
        f"select '{c}' as column_name, cast(min({c}) as varchar) as constant_value from {table} "
        f"having count(distinct {c}) = 1" for c in columns
    ) + ")"


ISSUES = """select m.dataset, rule, recommendation, 'warning' as severity,
    cast(case when rule = 'duplicate_rows' then max(value) else count(*) end as bigint) as affected_count,
    coalesce(string_agg(nullif(column_name, ''), ',' order by column_name), '') as affected
  from m join (values
    ('missing_values', 'missing_count', 0, 'Consider imputation or removal of missing values'),
    ('duplicate_rows', 'duplicate_rows', 0, 'Remove duplicate rows before analysis'),
    ('high_cardinality', 'high_cardinality', 0, 'Consider feature engineering for high cardinality columns'),
    ('outliers', 'outlier_pct', 5, 'Investigate and handle outliers appropriately')
  ) rules(rule, metric, threshold, recommendation) on m.metric = rules.metric and m.value > threshold
  group by m.dataset, rule, recommendation"""

TABLES = {
    "customer": (["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], ["c_name", "c_mktsegment"], []),
    "events": (["event_id", "ts", "user_id", "event_type", "value", "props"], ["event_type", "props"], ["ts"]),
    "lineitem": (list(LINE_TYPES), ["l_returnflag", "l_linestatus"], ["l_shipdate"]),
    "nation": (["n_nationkey", "n_name", "n_regionkey"], ["n_name"], []),
    "orders": (
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        ["o_orderstatus", "o_orderpriority"],
        ["o_orderdate"],
    ),
    "part": (["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"], ["p_name", "p_brand", "p_type"], []),
    "region": (["r_regionkey", "r_name"], ["r_name"], []),
    "supplier": (["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], ["s_name"], []),
    "documents": (["doc_id", "text", "lang", "source", "n_chars"], ["text", "lang", "source"], []),
    "embeddings": (["vec_id", "embedding", "label"], [], ["embedding"]),
    "pages": (["page_id", "url", "html"], ["url", "html"], []),
    "benchmark": (["item_id", "text"], ["text"], []),
    "labels": (["doc_id", "quality", "toxic"], [], []),
    "conversations": (["conv_id", "turn", "role", "text"], ["role", "text"], []),
}


def scaled_cell(c: str) -> str:
    """Distance from the mean in population standard deviations; a spread of 0 counts as 1."""
    spread = f"(select stddev_pop({q(c)}) from featured)"
    return f"({q(c)} - (select avg({q(c)}) from featured)) / coalesce(nullif({spread}, 0), 1)"


def table_measures(name: str) -> str:
    columns, texts, other = TABLES[name]
    return measures(name, name, columns, [c for c in columns if c not in texts + other], texts)


def md5_number(parts, digits: int) -> str:
    return f"('0x' || substr(md5(concat_ws(chr(1), {', '.join(parts)})), 1, {digits}))::bigint"


def split_hash(keys) -> str:
    return md5_number(["'42'"] + [f"{k}::varchar" for k in keys], 13)


def fingerprint(parts) -> str:
    return f"cast(sum({md5_number(parts, 15)}::decimal(38,0)) as varchar)"


def exact(c: str) -> str:
    """A double as the number of its millionths, as fingerprints count it."""
    return f"cast(cast(floor({c} * 1000000.0::double + 0.5::double) as bigint) as varchar)"


LINE_PRINT = fingerprint([exact(c) if c in MONEY else f"{c}::varchar" for c in LINE_TYPES])
EVENT_SETS = """(select event_type as name, cast(cast(ts as date) as varchar) as version, ts, user_id, value, props from events)"""


def event_stats() -> str:
    def one(c, kind, numeric):
        v = f"{c}" if numeric else "null::double"
        return f"""select name, version, '{c}' as column_name, '{kind}' as data_type,
            count(*) filter ({c} is null) as null_count, count(distinct {c}) as unique_count,
            {rnd(f'min({v})', 4)} as min_value, {rnd(f'max({v})', 4)} as max_value,
            {rnd(f'avg({v})', 4)} as mean_value, {rnd(f'stddev_samp({v})', 4)} as std_value
            from {EVENT_SETS} group by name, version"""

    return union([one("user_id", "bigint", True), one("value", "double", True), one("props", "string", False)])


RULES = f"""(select case when l_returnflag = 'R' then 1 else 0 end as label,
    case when l_quantity > 25 then 1 else 0 end as prediction, l_extendedprice as score from lineitem)"""
CELLS = """count(*) filter (label = 1 and prediction = 1) as tp, count(*) filter (label = 0 and prediction = 1) as fp,
    count(*) filter (label = 1 and prediction = 0) as fn, count(*) filter (label = 0 and prediction = 0) as tn"""


def metric_list() -> str:
    return f"""{rnd('(tp + tn)::double / (tp + fp + fn + tn)::double')} as accuracy,
        {rnd('coalesce(tp::double / nullif(tp + fp, 0)::double, 0)')} as precision,
        {rnd('coalesce(tp::double / nullif(tp + fn, 0)::double, 0)')} as recall,
        {rnd('coalesce((2 * tp)::double / nullif(2 * tp + fp + fn, 0)::double, 0)')} as f1_score"""


def anova() -> str:
    return union(
        f"""select '{c}' as column_name,
            case when ssw = 0 and ssb > 0 then 'inf'::double when ssw = 0 then null
                 else (ssb / (g - 1)) / (ssw / (n - g)) end as f_score
            from (select sum(n) as n, count(*) as g, sum(n * v) as ssw, sum(n * (m - gm) * (m - gm)) as ssb
                from (select Churn, count({q(c)})::double as n, avg({q(c)}) as m, var_pop({q(c)}) as v from featured group by Churn),
                     (select avg({q(c)}) as gm from featured))"""
        for c in NUMERIC_FEATURES
    )


def prepared_type(c: str) -> str:
    if c == "customerID":
        return "string"
    return "double" if c in REAL else "int"


ORIGINAL_TYPES = {"SeniorCitizen": "int", "tenure": "int", "MonthlyCharges": "double"}
ALL_FEATURE_ROWS = f"with {FEATURED} select {rounded_list(FEATURED_COLUMNS)} from featured"


def statements() -> dict[str, str]:
    cp = f"with {CP} "
    typed = f"with {CP}, {TYPED} "
    out: dict[str, str] = {}

    # sources and sinks
    out["scan_csv_roundtrip"] = cp + f"select {', '.join(rnd(c) + ' as ' + c if c == 'MonthlyCharges' else c for c in COLUMNS)} from cp"
    out["ingest_sources"] = cp + (
        "select source, count(*) as row_count, cast(sum(tenure) as bigint) as total_tenure, min(customerID) as first_customer, "
        "max(customerID) as last_customer from cp, (values ('store_a'), ('store_b')) s(source) group by source"
    )
    out["raw_zone_write"] = """select event_type as source, cast(cast(ts as date) as varchar) as ingest_date, 'events' as data_type,
        count(*) as row_count, 6 as column_count, 'event_id,ts,user_id,event_type,value,props' as columns, true as has_files
        from events group by 1, 2"""
    out["raw_zone_catalog"] = """select event_type as source, cast(cast(ts as date) as varchar) as ingest_date, count(*) as row_count,
        true as has_files, true as files_are_distinct from events group by 1, 2"""
    out["raw_zone_expire"] = """select event_type as source, cast(cast(ts as date) as varchar) as ingest_date, count(*) as row_count
        from events where cast(ts as date) >= date '2024-01-21' group by 1, 2"""
    out["raw_zone_retention"] = """select event_type as source,
        case when cast(ts as date) < date '2024-01-21' then 'expired' else 'kept' end as state,
        count(distinct cast(ts as date)) as day_count, count(*) as row_count, true as has_files from events group by 1, 2"""
    out["raw_zone_summary"] = """select event_type as source, count(*) as row_count,
        count(distinct cast(ts as date)) as day_count, 6 as column_count from events group by 1"""
    out["prepared_table_metadata"] = (
        f"with {PREPARED} select 'prepared' as table_name, count(*) as row_count, {len(PREPARED_COLUMNS)} as column_count, "
        f"'{','.join(PREPARED_COLUMNS)}' as columns from prepared"
    )
    out["latest_snapshot"] = """select table_name, created_at, row_count, user_count from (
        select *, row_number() over (partition by table_name order by created_at desc) as rk from (
          select event_type as table_name, cast(cast(ts as date) as varchar) as created_at, count(*) as row_count,
            count(distinct user_id) as user_count from events group by 1, 2)) where rk = 1"""

    # profiling
    out["profile_shape"] = (
        f"select 'lineitem' as dataset, count(*) as row_count, {len(LINE_TYPES)} as column_count, "
        f"'{','.join(LINE_TYPES)}' as columns from lineitem"
    )
    out["profile_missing"] = cp + missing("cp", COLUMNS)
    out["columns_with_missing"] = cp + f"select * from ({missing('cp', COLUMNS)}) where missing_count > 0"
    out["rows_with_missing"] = cp + rows_missing("cp", COLUMNS)
    kind = """case when trim(value) = '' then 'blank'
        when regexp_full_match(value, '[+-]?[0-9]+') then 'integer'
        when regexp_full_match(value, '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*') then 'decimal'
        when regexp_full_match(value, '[0-9]{4}-[0-9]{2}-[0-9]{2}') then 'date'
        when lower(value) in ('true', 'false') then 'boolean' else 'text' end"""
    out["profile_mixed_types"] = cp + f""", k as (select column_name, {kind} as kind, cast(sum(value_count) as bigint) as value_count
        from ({counts('cp', TEXTS)}) group by 1, 2)
        select * from k where column_name in (select column_name from k group by column_name having count(*) > 1)"""
    out["profile_duplicates"] = cp + duplicates("cp", COLUMNS)
    out["profile_duplicates_documents"] = duplicates("documents", ["text", "lang"])
    out["constant_columns"] = cp + (
        f"select * from ({constants('cp', COLUMNS)}) union all select 'source', 'store_a' union all select 'ingest_date', '2024-01-31'"
    )
    line_numbers = [c for c, k in LINE_TYPES.items() if k == "n"]
    out["profile_numeric_ranges"] = ranges("lineitem", line_numbers, 4)
    out["profile_negative"] = share("customer", ["c_custkey", "c_nationkey", "c_acctbal"], "< 0", "negative")
    out["profile_zero"] = share("lineitem", line_numbers, "= 0", "zero")
    out["profile_outliers_iqr"] = outliers("orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    out["profile_outliers_iqr_customers"] = cp + outliers("cp", NUMBERS)
    out["profile_categorical"] = cp + categories("cp", TEXTS)
    out["profile_top5"] = f"""select * from (select *, row_number() over (partition by column_name order by value_count desc, value) as value_rank
        from ({counts('documents', ['text', 'lang', 'source'])})) where value_rank <= 5"""
    out["profile_cardinality"] = cp + cardinality("cp", TEXTS)
    customers_measures = measures("cp", "customers", COLUMNS, NUMBERS, TEXTS)
    out["validate_table"] = cp + measures("cp", "customers", COLUMNS, NUMBERS, TEXTS, 6)
    out["validation_report"] = cp + f"""select 'customers' as dataset, * from ({missing('cp', COLUMNS, 6)})
        left join (select column_name, outlier_count::double as outlier_count, outlier_pct, lower_bound, upper_bound
                   from ({outliers('cp', NUMBERS)})) using (column_name)"""
    out["validation_report"] = out["validation_report"].replace(
        "select 'customers' as dataset, *", "select 'customers' as dataset, column_name, missing_count::double as missing_count, missing_pct, outlier_count, outlier_pct, lower_bound, upper_bound", 1
    )
    out["validation_summary"] = cp + f", m as ({customers_measures}) {ISSUES}"
    both = union([customers_measures, table_measures("orders")])
    out["validate_combined"] = cp + f""", m as ({both}), issues as ({ISSUES}),
        total as (select count(*) as n from issues)
        select 2::bigint as total_datasets, (select count(*) from cp) + (select count(*) from orders) as total_records,
          {len(COLUMNS) + 6}::bigint as total_features, n as overall_issues,
          case when n > 0 then 'Review individual dataset issues; Address missing values and duplicates before modeling' else 'Datasets appear to be in good quality for modeling' end
            as recommendation from total"""
    sketched = "'median_value', 'lower_bound', 'upper_bound', 'outlier_count', 'outlier_pct'"
    out["validate_incremental"] = f"""select dataset, "check", column_name, metric, {rnd('value', 4)} as value
        from ({table_measures('events')}) where metric not in ({sketched})"""
    out["sketched_ranks"] = """select column_name, true as median_is_near, true as outliers_are_near
        from (values ('event_id'), ('user_id'), ('value')) c(column_name)"""
    out["validate_all"] = f"""with m as ({union(table_measures(t) for t in TABLES)}), issues as ({ISSUES})
        select dataset, cast(max(value) filter (metric = 'row_count') as bigint) as row_count,
          cast(max(value) filter (metric = 'column_count') as bigint) as column_count,
          coalesce((select count(*) from issues i where i.dataset = m.dataset), 0) as issue_count
        from m where "check" = 'shape' group by dataset"""

    # cleaning and encoding
    number = "try_cast(nullif(TotalCharges, ' ') as double)"
    out["coerce_numeric"] = cp + f"select customerID, tenure, {rnd(number)} as TotalCharges from cp"
    out["recode_values"] = cp + "select customerID, case SeniorCitizen when 0 then 'No' when 1 then 'Yes' end as SeniorCitizen from cp"
    yes_no = ["Partner", "Dependents", "PhoneService", "PaperlessBilling", "Churn"]
    out["standardize_yes_no"] = cp + (
        f"select customerID, {', '.join(f'upper({c}[1]) || lower({c}[2:]) as {c}' for c in yes_no)} from cp"
    )
    out["impute_median"] = typed + (
        f"select customerID, tenure, {rnd('coalesce(TotalCharges, (select quantile_cont(TotalCharges, 0.5) from typed))')} as TotalCharges from typed"
    )
    out["impute_mode"] = cp + """select customerID, Contract, coalesce(PaymentMethod, (select PaymentMethod from cp
        where PaymentMethod is not null group by PaymentMethod order by count(*) desc, PaymentMethod limit 1)) as PaymentMethod from cp"""
    out["drop_duplicates"] = cp + f"select distinct * replace ({rnd('MonthlyCharges')} as MonthlyCharges) from cp"
    out["cap_outliers_iqr"] = f"with {CP}, {_limits('cp', NUMBERS)} select customerID, " + ", ".join(
        f"{rnd(_capped(c))} as {c}" for c in NUMBERS
    ) + " from cp, limits"
    out["capped_counts"] = (
        f"select column_name, outlier_count as outliers_found, lower_bound, upper_bound from ({outliers('lineitem', MONEY)})"
    )

    def capped_price(low, high):
        return f"""select o_orderkey, {rnd('least(greatest(o_totalprice, lo), hi)')} as o_totalprice
            from orders, (select {low} as lo, {high} as hi from orders)"""

    out["cap_outliers_zscore"] = capped_price(
        "avg(o_totalprice) - 3 * stddev_samp(o_totalprice)", "avg(o_totalprice) + 3 * stddev_samp(o_totalprice)"
    )
    out["cap_outliers_pct"] = capped_price("quantile_cont(o_totalprice, 0.01)", "quantile_cont(o_totalprice, 0.99)")
    out["encode_binary"] = cp + (
        f"select customerID, {', '.join(f'case when lower({c}) = {chr(39)}yes{chr(39)} then 1 else 0 end as {c}' for c in yes_no)} from cp"
    )
    out["route_cardinality"] = f"""select column_name, count(*) as distinct_count,
        case when count(*) > 50 then 'label' else 'one_hot' end as encoding
        from ({counts('part', ['p_name', 'p_brand', 'p_type'])}) group by column_name"""
    out["encode_label"] = "select p_partkey, dense_rank() over (order by p_name) - 1 as p_name from part"
    out["encode_label_texts"] = "select doc_id, dense_rank() over (order by text) - 1 as text from documents"
    out["encode_one_hot"] = cp + "select customerID, " + ", ".join(
        f"case when {c} = '{v}' then 1 else 0 end as {q(f'{c}_{v}')}"
        for c in ["Contract", "InternetService", "MultipleLines"]
        for v in CATEGORIES[c]
    ) + " from cp"
    out["prepare_table"] = f"with {PREPARED} select {rounded_list(PREPARED_COLUMNS)} from prepared"
    shifted = PREPARED.replace(RECIPE, f"select * replace (tenure + 1 as tenure) from ({RECIPE})")
    pair = f"count(*) as row_count, {len(PREPARED_COLUMNS)} as column_count, {rnd('avg(tenure)')} as mean_tenure, {rnd('avg(TotalCharges)')} as mean_total"
    out["prepare_pair"] = (
        f"select * from (with {PREPARED} select 'store_a' as dataset, {pair} from prepared) union all "
        f"select * from (with {shifted} select 'store_b' as dataset, {pair} from prepared)"
    )
    null_cells = " + ".join(f"count(*) filter ({c} is null)" for c in COLUMNS)
    prepared_nulls = " + ".join(f"count(*) filter ({q(c)} is null)" for c in PREPARED_COLUMNS)
    out["prep_report_summary"] = f"""with {PREPARED},
        a as (select count(*) as n, {null_cells} as nulls from cp), b as (select count(*) as n, {prepared_nulls} as nulls from prepared),
        ad as (select count(*) as n from (select distinct * from cp)), bd as (select count(*) as n from (select distinct * from prepared))
        select 'row_count' as metric, a.n as original, b.n as prepared from a, b union all
        select 'duplicate_rows', a.n - ad.n, b.n - bd.n from a, ad, b, bd union all
        select 'missing_values', a.nulls, b.nulls from a, b union all
        select 'column_count', {len(COLUMNS)}, {len(PREPARED_COLUMNS)}"""
    original = union(
        f"select '{c}' as column_name, '{ORIGINAL_TYPES.get(c, 'string')}' as original_type, count(*) filter ({c} is null) as original_nulls from cp"
        for c in COLUMNS
    )
    after = union(
        f"select '{c}' as column_name, '{prepared_type(c)}' as prepared_type, count(*) filter ({q(c)} is null) as prepared_nulls from prepared"
        for c in PREPARED_COLUMNS
    )
    out["prep_report_columns"] = f"with {PREPARED} select * from ({original}) full outer join ({after}) using (column_name)"
    out["eda_histogram"] = f"""with w as (select min(l_extendedprice) as lo, (max(l_extendedprice) - min(l_extendedprice)) / 30 as width from lineitem),
        b as (select cast(least(floor((l_extendedprice - lo) / width), 29) as int) as bin, count(*) as value_count from lineitem, w group by 1)
        select bin, {rnd('lo + bin * width')} as bin_start, {rnd('lo + bin * width + width')} as bin_end, value_count from b, w"""
    out["eda_boxplot_by_class"] = f"""select l_returnflag as class, count(l_extendedprice) as value_count,
        {rnd('min(l_extendedprice)')} as min_value, {rnd('max(l_extendedprice)')} as max_value,
        {rnd('quantile_cont(l_extendedprice, 0.25)')} as q1, {rnd('quantile_cont(l_extendedprice, 0.5)')} as median,
        {rnd('quantile_cont(l_extendedprice, 0.75)')} as q3 from lineitem group by 1"""
    out["eda_correlation"] = union(
        f"select '{a}' as column_a, '{b}' as column_b, {rnd(f'corr({a}, {b})')} as correlation from lineitem"
        for a in MONEY for b in MONEY
    )

    # features
    out["bin_tenure"] = cp + f"select customerID, tenure, {group_label('tenure', TENURE_BINS)} as tenure_group from cp"
    out["tenure_math"] = cp + (
        f"select customerID, {rnd('tenure / 12.0::double')} as tenure_years, tenure * tenure as tenure_squared, "
        f"{rnd('ln(1 + tenure::double)')} as tenure_log from cp"
    )
    out["tenure_one_hot"] = cp + f"select customerID, {', '.join(flags('tenure', TENURE_BINS, 'tenure'))} from cp"
    filled_total = "coalesce(TotalCharges, MonthlyCharges)"
    out["ratio_avg_monthly"] = typed + f"select customerID, {rnd(safe_ratio(filled_total, 'tenure'))} as avg_monthly_charges from typed"
    out["ratio_total_monthly"] = typed + (
        f"select customerID, {rnd(safe_ratio('TotalCharges', 'tenure'))} as avg_monthly_charges, "
        f"{rnd(safe_ratio('TotalCharges', 'MonthlyCharges'))} as total_to_monthly_ratio from typed"
    )
    out["bin_monthly"] = typed + (
        f"select customerID, {group_label('MonthlyCharges', MONTHLY_BINS)} as monthly_group, "
        f"{', '.join(flags('MonthlyCharges', MONTHLY_BINS, 'monthly_charges'))} from typed"
    )
    out["bin_total"] = typed + (
        f"select customerID, {group_label('TotalCharges', TOTAL_BINS)} as total_group, "
        f"{', '.join(flags('TotalCharges', TOTAL_BINS, 'total_charges'))} from typed"
    )
    out["service_total"] = of_features("customerID", "total_services")
    out["service_density"] = of_features("customerID", "service_density")
    out["service_premium"] = of_features("customerID", "has_premium_services")
    out["interact_tenure_monthly"] = of_features("customerID", "tenure_monthly_interaction")
    out["interact_contract_payment"] = of_features("customerID", *[f"{a}_{b}_interaction" for a, b in CROSSED])
    out["interact_senior_service"] = of_features("customerID", "senior_service_interaction")
    out["transform_table"] = ALL_FEATURE_ROWS

    def scaled(centre, spread):
        stats = ", ".join(f"{centre.format(c=c)} as a_{c}, {spread.format(c=c)} as b_{c}" for c in MONEY)
        cells = ", ".join(f"{rnd(f'({c} - a_{c}) / b_{c}')} as {c}" for c in MONEY)
        return f"select {', '.join(LINE_KEYS)}, {cells} from lineitem, (select {stats} from lineitem)"

    out["scale_standard"] = scaled("avg({c})", "stddev_pop({c})")
    out["scale_minmax"] = scaled("min({c})", "(max({c}) - min({c}))")
    out["scale_robust"] = scaled("quantile_cont({c}, 0.5)", "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))")
    out["anova_f_scores"] = f"with {FEATURED} select column_name, {rnd('f_score', 4)} as f_score from ({anova()})"
    means = union(
        f"select '{c}' as column_name, count({q(c)}) as row_count, {rnd(f'avg({q(c)})')} as mean_value from featured"
        for c in [*NUMERIC_FEATURES, "Churn"]
    )
    places = ", ".join(f"('{c}', {i})" for i, c in enumerate(NUMERIC_FEATURES))
    out["select_k_best"] = f"""with {FEATURED}, best as (select column_name from ({anova()}) join (values {places}) p(column_name, place) using (column_name)
        order by round(f_score, 6) desc nulls last, place desc limit 20)
        select * from ({means}) where column_name in (select column_name from best) or column_name = 'Churn'"""
    out["split_features_labels"] = (
        f"with {FEATURED} select customerID, {rnd('tenure_squared')} as tenure_squared, {len(NUMERIC_FEATURES)} as feature_count, Churn from featured"
    )
    out["split_features_labels"] = out["split_features_labels"].replace(rnd("tenure_squared"), "tenure_squared", 1)

    # feature store and versions
    day_rows = f"select name, version, count(*) as row_count from {EVENT_SETS} group by name, version"
    out["feature_registry"] = day_rows
    out["feature_store_list"] = day_rows
    out["feature_column_stats"] = event_stats()
    out["feature_catalog"] = f"select * from ({day_rows}) join ({event_stats()}) using (name, version)"
    out["feature_store_write"] = (
        f"with {PREPARED} select 'churn_features' as name, '1' as version, 'Feature set churn_features version 1' as description, "
        f"{len(NUMERIC_FEATURES)} as feature_count, count(*) as row_count, 'customerID' as key, 'Churn' as label from prepared"
    )
    out["feature_store_latest"] = typed + (
        f"select distinct customerID, tenure + 1 as tenure, {rnd('MonthlyCharges')} as MonthlyCharges, {rnd('TotalCharges')} as TotalCharges, Churn from typed"
    )
    out["feature_set_metadata"] = f"with {PREPARED} " + union(
        f"""select '{c}' as column_name, '{prepared_type(c)}' as data_type, count(*) filter ({q(c)} is null) as null_count,
            count(distinct {q(c)}) as unique_count, {rnd(f'min({q(c)})', 4)} as min_value, {rnd(f'max({q(c)})', 4)} as max_value,
            {rnd(f'avg({q(c)})', 4)} as mean_value, {rnd(f'stddev_samp({q(c)})', 4)} as std_value from prepared"""
        for c in PREPARED_COLUMNS if c not in ("customerID", "Churn")
    )
    out["stored_label_distribution"] = """select 'orders' as name, 'a' as version, o_orderstatus as label, count(*) as label_count
        from orders where o_totalprice > 1000 group by o_orderstatus"""
    out["raw_zone_relanded"] = """with d as (select event_type as source, cast(ts as date) as ingest_date, count(*) as n,
            count(*) filter (value > 50) as again from events group by 1, 2)
        select source, cast(ingest_date as varchar) as ingest_date, case when again > 0 then again else n end as row_count,
            case when again > 0 then 2::bigint else 1 end as commit_number
        from d where ingest_date >= date '2024-01-21'"""
    out["label_distribution"] = f"with {PREPARED} select Churn as label, count(*) as label_count from prepared group by 1"
    others = [c for c in LINE_TYPES if c != "l_returnflag"]
    out["dataset_fingerprint"] = f"select count(*) as row_count, {LINE_PRINT} as fingerprint from lineitem"
    out["version_record"] = f"""select count(*) as row_count, {len(others)} as feature_count, '{','.join(others)}' as columns,
        {LINE_PRINT} as fingerprint, 'Data version - ' || count(*) || ' rows, {len(others)} features' as message from lineitem"""
    event_print = fingerprint(["event_id::varchar", "ts::varchar", "user_id::varchar", "event_type", exact("value"), "props"])
    out["version_history"] = f"""select *, row_count - lag(row_count) over w as row_change,
        coalesce(fingerprint <> lag(fingerprint) over w, true) as content_changed
        from (select event_type as name, cast(cast(ts as date) as varchar) as version, count(*) as row_count, {event_print} as fingerprint
              from events group by 1, 2)
        window w as (partition by name order by version)"""
    out["version_log"] = f"""with v as (
          select count(*) as n, {LINE_PRINT} as f, count(*) filter (l_returnflag <> 'R') as m,
                 (select {LINE_PRINT} from lineitem where l_returnflag <> 'R') as g from lineitem)
        select 'v20240101_000000' as version_tag, n as row_count, f as fingerprint, null::bigint as row_change, true as content_changed from v
        union all select 'v20240102_000000', n, f, 0, false from v
        union all select 'v20240103_000000', m, g, m - n, f <> g from v"""
    out["stored_feature_catalog"] = typed + """, c as (select distinct customerID, tenure, MonthlyCharges, TotalCharges, Churn from typed)
        select 'charges' as name, 'a' as version, count(*) filter (tenure > 0) as row_count, 3 as feature_count, 3::bigint as catalog_rows from c
        union all select 'money', 'a', count(*), 2, 2 from c"""

    # models
    out["model_matrix"] = typed + (
        f"select customerID, {rnd('tenure')} as tenure, {rnd('MonthlyCharges')} as MonthlyCharges, "
        f"{rnd('coalesce(TotalCharges, (select quantile_cont(TotalCharges, 0.5) from typed))')} as TotalCharges, "
        "case when Churn = 'Yes' then 1 else 0 end as Churn from typed"
    )
    out["stratified_split"] = f"""with {PREPARED}, h as (select customerID, Churn, {split_hash(['customerID'])} as h from prepared)
        select customerID, Churn, case when row_number() over (partition by Churn order by h)
          <= floor(count(*) over (partition by Churn) * 0.2 + 0.5) then 'test' else 'train' end as split from h"""
    out["stratified_split_lines"] = f"""select l_returnflag, split, count(*) as row_count, cast(sum(l_orderkey) as bigint) as order_total from (
        select l_returnflag, l_orderkey, case when row_number() over (partition by l_returnflag order by h)
          <= floor(count(*) over (partition by l_returnflag) * 0.2 + 0.5) then 'test' else 'train' end as split
        from (select l_returnflag, l_orderkey, {split_hash(LINE_KEYS)} as h from lineitem)) group by 1, 2"""
    out["hashed_split"] = f"""with {PREPARED} select customerID, Churn,
        case when {split_hash(['customerID'])} < {int(0.2 * 16**13)} then 'test' else 'train' end as split from prepared"""
    out["cv_folds"] = f"""select l_returnflag, cast({split_hash(LINE_KEYS)} % 5 as int) as fold, count(*) as row_count
        from lineitem group by 1, 2"""
    out["class_weights"] = f"""select l_returnflag as label, count(*) as label_count,
        {rnd('(select count(*) from lineitem)::double / ((select count(distinct l_returnflag) from lineitem) * count(*))::double')} as class_weight
        from lineitem group by 1"""
    out["eval_confusion"] = f"select {CELLS} from {RULES}"
    out["eval_metrics"] = f"select tp, fp, fn, tn, {metric_list()} from (select {CELLS} from {RULES})"
    out["eval_roc_auc"] = f"""select cast(sum(p) as bigint) as positive_count, cast(sum(n) as bigint) as negative_count,
        {rnd('sum(p * (below + n / 2.0::double))::double / (sum(p)::double * sum(n)::double)')} as roc_auc
        from (select p, n, coalesce(sum(n) over (order by score rows between unbounded preceding and 1 preceding), 0) as below
              from (select score, count(*) filter (label = 1) as p, count(*) filter (label = 0) as n from {RULES} group by score))"""
    guesses = {"by_discount": "l_discount > 0.05", "by_quantity": "l_quantity > 25", "by_tax": "l_tax < 0.03"}
    guessed = union(
        f"select '{m}' as model, case when l_returnflag = 'R' then 1 else 0 end as label, case when {t} then 1 else 0 end as prediction from lineitem"
        for m, t in guesses.items()
    )
    out["model_comparison"] = f"""with s as (select model, {metric_list()} from (select model, {CELLS} from ({guessed}) group by model))
        select *, model = (select model from s order by f1_score desc, model limit 1) as is_best from s"""
    out["run_summary"] = f"""with {PREPARED}, m1 as ({customers_measures}), m as (select * from m1 union all select * replace ('store_b' as dataset) from m1),
        n as (select count(*) as raw from cp), p as (select count(*) as ready from prepared),
        i as (select count(*) as found from ({ISSUES}) where dataset = 'customers'),
        s as (select * from (values ('store_a'), ('store_b')) s(dataset))
        select 'land' as stage, dataset, raw as row_count, {len(COLUMNS)} as column_count from s, n union all
        select 'validate', dataset, found, {len(COLUMNS)} from s, i union all
        select 'prepare', dataset, ready, {len(PREPARED_COLUMNS)} from s, p union all
        select 'transform', 'store_a', ready, {len(FEATURED_COLUMNS)} from p union all
        select 'version', 'store_a', ready, {len(FEATURED_COLUMNS) - 1} from p union all
        select 'train', 'store_a', 4, {len(NUMERIC_FEATURES)}"""
    tests = f"""{PREPARED}, r as (select Churn, row_number() over (partition by Churn order by {split_hash(['customerID'])})
          <= floor(count(*) over (partition by Churn) * 0.2 + 0.5) as is_test from prepared),
        t as (select count(*) as test_rows, count(*) filter (Churn = 1) as positive_rows from r where is_test)"""
    facts = "test_rows, positive_rows, true as shares_in_range, true as accuracy_agrees from t"
    out["trained_model_facts"] = f"""with {tests} select model, {facts}, (values ('logistic_regression'), ('random_forest'),
        ('gradient_boosting'), ('kernel_svc')) m(model)"""
    out["kernel_svc_facts"] = f"""with {tests} select test_rows, positive_rows, true as scores_are_shares,
        true as predictions_follow_scores, true as ranks_well, true as is_calibrated from t"""
    out["weighted_model_facts"] = f"with {tests} select 'logistic_regression' as model, {facts}"
    out["best_model_facts"] = f"""select section, item_count, true as is_top from (values ('comparison', 20::bigint), ('best_model', 1),
        ('importance', {len(NUMERIC_FEATURES)})) s(section, item_count)"""
    out["importance_facts"] = f"select {len(NUMERIC_FEATURES)}::bigint as feature_count, true as sums_to_one, true as none_negative"
    out["fold_facts"] = f"""with {PREPARED} select cast({split_hash(['customerID'])} % 5 as int) as fold, count(*) as row_count,
        true as summary_agrees from prepared group by 1"""
    out["component_facts"] = "select range::int as component, true as not_above_the_one_before, true as is_share from range(1, 6)"
    out["projection_facts"] = f"""with {PREPARED} select range::int as component, (select count(*) from prepared) as row_count,
        true as is_centred, true as has_its_share, true as is_exact, true as is_uncorrelated from range(1, 6)"""
    out["tuning_facts"] = "select penalty::double as penalty, true as is_share from (values (0.001), (0.01), (0.1)) p(penalty)"

    # stated goals
    out["target_encoding"] = cp + f""", g as (select avg(case when Churn = 'Yes' then 1.0::double else 0 end) as overall from cp),
        e as (select PaymentMethod as pm, count(*) as n, sum(case when Churn = 'Yes' then 1.0::double else 0 end) as total
              from cp where PaymentMethod is not null group by 1)
        select customerID, {rnd('coalesce((total + overall * 10.0) / (n + 10.0), overall)')} as payment,
          case when Churn = 'Yes' then 1 else 0 end as target from cp left join e on PaymentMethod = pm, g"""
    def others(column):
        """The mean of the other folds' rows, pulled towards their overall mean by the method of moments."""
        return f"""cells_{column} as (select {column} as v, fold, count(*) as n, sum(target)::double as t from r where {column} is not null group by 1, 2),
            o_{column} as (select v.v, f.fold, f.overall, v.n - coalesce(c.n, 0) as n, v.t - coalesce(c.t, 0) as t
                from (select v, sum(n) as n, sum(t) as t from cells_{column} group by v) v cross join outside f
                left join cells_{column} c on c.v = v.v and c.fold = f.fold),
            m_{column} as (select fold, sum(n)::double as n, sum(t) / sum(n)::double as p, count(*) as k, sum(n::double * n) as squares,
                sum(t * t / n::double) as weighted from o_{column} where n > 0 group by fold),
            w_{column} as (select fold, p * (1 - p) as chance, (weighted - n * p * p - (k - 1) * p * (1 - p)) / (n - squares / n) as spread from m_{column}),
            e_{column} as (select v, o.fold, case when spread > 0 then (t + overall * chance / spread) / (n + chance / spread) else overall end as mean
                from o_{column} o join w_{column} w using (fold) where n > 0)"""

    out["target_encoding_out_of_fold"] = cp + f""", r as (select customerID, PaymentMethod as payment,
            cast(cast(floor(MonthlyCharges) as bigint) as varchar) as charge, case when Churn = 'Yes' then 1 else 0 end as target,
            cast({split_hash(['customerID'])} % 5 as int) as fold from cp),
        f as (select fold, count(*) as n, sum(target)::double as t from r group by fold),
        outside as (select fold, ((select sum(t) from f) - t) / ((select sum(n) from f) - n)::double as overall from f),
        {others('payment')}, {others('charge')}
        select customerID, {rnd('coalesce(p.mean, overall)')} as payment, {rnd('coalesce(c.mean, overall)')} as charge, target
        from r join outside using (fold) left join e_payment p on p.v = payment and p.fold = r.fold
        left join e_charge c on c.v = charge and c.fold = r.fold"""
    out["stream_without_repeats"] = """select event_type, count(*) as row_count, count(distinct event_id) as event_count,
        cast(sum(event_id) as bigint) as id_total from events group by event_type"""
    cuts = " + ".join(
        f"case when value > (select quantile_cont(value, {i / 10}) from events where ts < timestamp '2024-01-16') then 1 else 0 end"
        for i in range(1, 10)
    )
    out["drift_psi"] = f"""with b as (select {cuts} as bin, count(*) filter (ts < timestamp '2024-01-16') as base_count,
            count(*) filter (ts >= timestamp '2024-01-16') as other_count from events group by 1),
        s as (select *, greatest(base_count::double / (sum(base_count) over ())::double, 0.0001) as bs,
            greatest(other_count::double / (sum(other_count) over ())::double, 0.0001) as os from b)
        select bin, base_count, other_count, {rnd('bs')} as base_share, {rnd('os')} as other_share, {rnd('(os - bs) * ln(os / bs)')} as psi from s"""
    checks = {
        "blank_total": "trim(TotalCharges) <> ''",
        "known_payment": "PaymentMethod is not null",
        "tenure_in_range": "tenure between 0 and 72",
        "positive_charge": "MonthlyCharges > 0",
    }
    checks["all_rules"] = " and ".join(f"({t})" for t in checks.values())
    present = " + ".join(f"count({c})" for c in COLUMNS)
    lines = [f"select '{n}' as rule, count(*) filter ({t}) as passed, count(*) as total from cp" for n, t in checks.items()]
    lines.append(f"select 'coverage', {present}, count(*) * {len(COLUMNS)} from cp")
    out["quality_score"] = cp + f"select *, {rnd('passed * 100.0::double / total')} as passed_pct from ({union(lines)})"
    # on the stream copies are kept, limits come from the distinct rows
    streamed = FEATURED.replace(") from dist, limits)", ") from filled, limits)").replace("select dist.* replace", "select filled.* replace")
    out["stream_features"] = f"with {streamed} select {rounded_list(FEATURED_COLUMNS)} from featured"
    windows = """select date_trunc('hour', ts) as window_start, event_type, count(*) as row_count,
        count(*) filter (value is null) as missing_count, count(*) filter (value < 0) as negative_count,
        cast(sum(cast(floor(value * 100) as bigint)) as bigint) as total_cents from events group by 1, 2"""
    out["window_quality_batch"] = windows
    out["window_quality_stream"] = windows
    out["stream_scores"] = f"with {streamed} select customerID, Churn as label, true as is_valid from featured"
    bins = {"tenure": TENURE_BINS, "monthly_charges": MONTHLY_BINS, "total_charges": TOTAL_BINS}
    flags_left = {f"{prefix}_{name}" for prefix, groups in bins.items() for name, _, _ in groups}
    cells = union(
        f"select customerID, '{c}' as column_name, {rnd(f'{q(c)}::double' if c in flags_left else scaled_cell(c))} as value from featured"
        for c in NUMERIC_FEATURES
    )
    out["transform_scaled"] = f"""with {FEATURED}, best as (select column_name from ({anova()}) join (values {places}) p(column_name, place) using (column_name)
        order by round(f_score, 6) desc nulls last, place desc limit 20)
        select * from ({cells}) where column_name in (select column_name from best)
        union all select customerID, 'Churn', Churn::double from featured"""
    long = union(f"select customerID, '{c}' as column_name, {q(c)}::double as value from featured" for c in NUMERIC_FEATURES)
    out["eda_correlation_features"] = f"""with {FEATURED}, long as ({long}),
        c as (select a.column_name as column_a, b.column_name as column_b, corr(a.value, b.value) as r
              from long a join long b using (customerID) group by 1, 2)
        select column_a, column_b, {rnd('r', 4)} as correlation from c where r is not null and not isnan(r)"""
    price = lambda p: rnd(f"quantile_cont(o_totalprice, {p})")
    out["eda_boxplot_by_customer"] = f"""select o_custkey as class, count(o_totalprice) as value_count, {rnd('min(o_totalprice)')} as min_value,
        {rnd('max(o_totalprice)')} as max_value, {price(0.25)} as q1, {price(0.5)} as median, {price(0.75)} as q3 from orders group by 1"""
    out["oversampled_lines"] = f"""with n as (select l_returnflag as f, count(*) as n from lineitem group by 1),
        t as (select f, (select max(n) from n)::double / n::double as times from n),
        r as (select l_returnflag, l_orderkey, floor(times)::bigint
              + case when {split_hash(LINE_KEYS)} < floor((times - floor(times)) * {16**13}.0::double) then 1 else 0 end as copies
              from lineitem join t on f = l_returnflag)
        select l_returnflag, cast(sum(copies) as bigint) as row_count, cast(sum(copies * l_orderkey) as bigint) as order_total from r group by 1"""
    def evened(rows: str, label: str, keys) -> str:
        """Copies of each row once every class is as large as the largest."""
        return f"""s as (select {label} as f, count(*) as n from {rows} group by 1), m as (select max(n) as largest from s),
            p as (select r.*, n, largest, row_number() over (partition by {label} order by {split_hash(keys)}) as place
                  from {rows} r join s on f is not distinct from {label} cross join m),
            e as (select *, 1 + (largest - n) // n + case when place <= (largest - n) % n then 1 else 0 end as copies from p)"""

    out["synthetic_customers"] = f"""with {PREPARED}, {evened('prepared', 'Churn', ['customerID'])}
        select customerID, Churn, cast(copies as bigint) as row_count, cast(copies - 1 as integer) as last_synthetic, true as in_range from e"""
    out["synthetic_lines"] = f"""with {evened('lineitem', 'l_returnflag', LINE_KEYS)}
        select l_returnflag, cast(sum(copies) as bigint) as row_count, cast(sum(copies - 1) as bigint) as synthetic_count,
            cast(sum(copies * l_orderkey) as bigint) as order_total, min(l_quantity)::double as min_quantity, max(l_quantity)::double as max_quantity
        from e group by 1"""
    out["snapshot_fallback"] = """select 'fallback' as found, count(*) as row_count, cast(sum(o_orderkey) as bigint) as total from orders
        union all select 'newest', count(*), cast(sum(o_orderkey) as bigint) from orders where o_orderstatus = 'F'"""
    return out
