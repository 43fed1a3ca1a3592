"""Financial statements: union, enrichment, account sums and the quarterly metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.functions.clean import date_strict, quarter_label
from issuerlake.schemas import (
    ACCOUNT_TYPES, ACCOUNTS_EXACT, ACCOUNTS_PREFIX, AGGREGATIONS, AMOUNT_SCALES, FINANCIALS_COLUMNS,
)

# Amounts are added as decimals: double sums depend on the order in which tasks finish.
AMOUNT = "decimal(28,6)"
GROUP_KEYS = ["enr_aggregation_type", "CNPJ_CIA", "DT_REFER"]


def union_itr_dfp(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by name of quarterly and annual rows with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_ragged(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by name; columns a part lacks are null. One part per source layout, not per asset."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def scale_amounts(df: DataFrame, amount: str = "VL_CONTA", scale: str = "ESCALA_MOEDA") -> DataFrame:
    """Amount in units; an unknown scale gives null."""
    factor = F.create_map(*[F.lit(x) for kv in AMOUNT_SCALES.items() for x in kv])
    units = F.col(amount).cast("decimal(20,6)") * F.try_element_at(factor, F.col(scale)).cast("decimal(7,0)")
    return df.withColumn("enr_adjusted_account_value", units.cast(AMOUNT))


def enrich(df: DataFrame, run: dict[str, str], period: str = "DT_FIM_EXERC") -> DataFrame:
    """Lineage literals of the run, quarter and year of the period end, balance-sheet side."""
    doc_type = F.col("enr_origin_document_type")
    account_type = F.when(doc_type == "BALANCO_PATRIMONIAL_ATIVO", ACCOUNT_TYPES["BALANCO_PATRIMONIAL_ATIVO"]).when(
        doc_type == "BALANCO_PATRIMONIAL_PASSIVO", ACCOUNT_TYPES["BALANCO_PATRIMONIAL_PASSIVO"]
    )
    return df.withColumns(
        {
            "enr_last_updated_date": F.lit(run["last_update"]),
            "enr_ingestion_trace_id": F.lit(run["trace_id"]),
            "enr_source": F.lit(run["source"]),
            "enr_quarter": quarter_label(F.col(period)),
            "enr_year": F.year(period),
            "enr_account_type": account_type,
        }
    )


def split_by_aggregation(df: DataFrame, col: str = "enr_aggregation_type") -> DataFrame:
    """Consolidated and individual rows, told apart by the column; other values are dropped."""
    return df.filter(F.col(col).isin(list(AGGREGATIONS.values())))


def parse_statement_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({c: date_strict(F.col(c)) for c in ("DT_REFER", "DT_FIM_EXERC")})


def leaves(df: DataFrame, keys: list[str], code: str = "CD_CONTA") -> DataFrame:
    """Rows whose account has no direct child in the same group.

    Written as an outer join: the optimizer would move an anti join below the sums it is to run on.
    """
    parents = (
        df.select(*keys, F.regexp_extract(code, r"^(.*)\.[^.]+$", 1).alias(code)).filter(F.col(code) != "").distinct()
    )
    marked = parents.withColumn("_parent", F.lit(True))
    return df.join(marked, [*keys, code], "left").filter(F.col("_parent").isNull()).drop("_parent")


def account_sums(
    df: DataFrame,
    keys: list[str] = GROUP_KEYS,
    exact: dict[str, str] = ACCOUNTS_EXACT,
    prefix: dict[str, str] = ACCOUNTS_PREFIX,
    value: str = "enr_adjusted_account_value",
    code: str = "CD_CONTA",
    leaf_only: bool = False,
) -> DataFrame:
    """Conditional sums over account codes, all in one aggregation.

    Rows are combined before the shuffle, so a group of any size reaches the reducers as one row
    per task. Groups without a matching account are kept with zeros; rows with a null key are not.
    Prefix sums add a parent and its children, as the source tables intend; ``leaf_only`` drops
    accounts that have a child in the group, after the rows of a code are summed, so that the join runs on
    a few rows per group.
    """
    rows = df.dropna(subset=keys)
    if leaf_only:
        rows = leaves(rows.groupBy(*keys, code).agg(F.sum(value).alias(value)), keys, code)

    def total(hit: Column) -> Column:
        return F.coalesce(F.sum(F.when(hit, F.col(value))), F.lit(0).cast("decimal(38,6)"))

    c = F.col(code)
    return rows.groupBy(*keys).agg(
        *[total(c == v).alias(n) for n, v in exact.items()],
        *[total(F.startswith(c, F.lit(v))).alias(n) for n, v in prefix.items()],
    )


def financials_quarterly(enriched: DataFrame) -> DataFrame:
    """Quarterly metrics of every issuer, reference date and aggregation type."""
    return financials_of_sums(account_sums(enriched))


def financials_of_sums(s: DataFrame) -> DataFrame:
    """Quarterly metrics of the account sums of a group; sums of parts can be added before."""
    total_debt = F.col("debt_short_term") + F.col("debt_long_term")
    derived = {
        "issuer_cnpj": F.col("CNPJ_CIA"),
        "date": F.col("DT_REFER"),
        "quarter": quarter_label(F.col("DT_REFER")),
        "year": F.year("DT_REFER"),
        "ebitda": F.col("ebit") + F.col("depreciation"),
        "total_debt": total_debt,
        "net_debt": total_debt - F.col("cash"),
        "interest_paid": F.abs(F.when(F.col("interest_cf") != 0, F.col("interest_cf")).otherwise(F.col("interest_is"))),
        "capex": F.abs("capex_raw"),
    }
    labels = ("issuer_cnpj", "date", "quarter", "year")
    return s.select(
        "enr_aggregation_type",
        *[
            (derived.get(n, F.col(n)) if n in labels else derived.get(n, F.col(n)).cast("double")).alias(n)
            for n in FINANCIALS_COLUMNS
        ],
    )


def dataset_ref_date(df: DataFrame, col: str = "DT_FIM_EXERC", key: str = "enr_aggregation_type") -> DataFrame:
    """Reference date of each output: its latest period end, as ISO text."""
    return df.groupBy(key).agg(F.date_format(F.max(col), "yyyy-MM-dd").alias("ref_date"))
