"""Transaction scans.

Time windows and model filters are literals computed before planning, so they reach
the file scan; ``as_of`` is always an argument, never the clock.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weighlens.schemas import (
    ALL_METRICS, DAYS_BACK, TRANSACTION_DATA, require,
)

_START = "transaction_start_time"


def nested(df: DataFrame, name: str) -> Column:
    """Column by name, or the field of that name inside ``transaction_data``."""
    return F.col(name) if name in df.columns else F.col(f"transaction_data.{name}")


def _instant(df: DataFrame, name: str, moment: datetime) -> Column:
    """Literal of the column's own type: a mixed comparison would not be pushed down."""
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast(df.schema[name].dataType)


def _midnight(moment: datetime) -> datetime:
    return moment.replace(hour=0, minute=0, second=0, microsecond=0)


def scan_transactions(
    tx: DataFrame, deployment_id: int, as_of: datetime, days_back: int = DAYS_BACK,
    model_id: int | None = None, metrics: tuple[str, ...] = ALL_METRICS,
) -> DataFrame:
    """One deployment's transactions from midnight ``days_back`` days ago to the end of today."""
    require(tx, "transaction_metric", "deployment_id", _START)
    rows = tx.filter(
        F.col("transaction_metric").isin(*metrics)
        & (F.col("deployment_id") == deployment_id)
        & (F.col(_START) >= _instant(tx, _START, _midnight(as_of - timedelta(days=days_back))))
        & (F.col(_START) < _instant(tx, _START, _midnight(as_of + timedelta(days=1))))
    )
    return rows if model_id is None else rows.filter(nested(tx, "model_id") == model_id)


def scan_fleet(
    tx: DataFrame, models: DataFrame, as_of: datetime, days_back: int = DAYS_BACK, metrics: tuple[str, ...] = ALL_METRICS,
) -> DataFrame:
    """The rows of all deployments in ``models`` (deployment_id, model_id) in the time window of ``scan_transactions``.

    A deployment gives the rows of its model, or all its rows if its model has none in the window.
    """
    rows = tx.filter(
        F.col("transaction_metric").isin(*metrics)
        & (F.col(_START) >= _instant(tx, _START, _midnight(as_of - timedelta(days=days_back))))
        & (F.col(_START) < _instant(tx, _START, _midnight(as_of + timedelta(days=1))))
    )
    own = models.select("deployment_id", F.col("model_id").alias("_own"))
    model = nested(tx, "model_id")
    # the few sums of (deployment, model) say which deployments have rows of their model
    seen = rows.groupBy("deployment_id", model.alias("_own")).agg(F.count(F.lit(1)).alias("_n"))
    own = own.join(seen, ["deployment_id", "_own"], "left").select("deployment_id", "_own", F.col("_n").isNotNull().alias("_has"))
    return rows.join(own, "deployment_id").filter((model == F.col("_own")) | ~F.col("_has")).select(*tx.columns)


_DATE_MATH = re.compile(r"^now(?:([+-])(\d*)d)?(/d)?$")


def _resolve(text: str, as_of: datetime) -> datetime:
    found = _DATE_MATH.match(text)
    if not found:
        return datetime.fromisoformat(text)
    sign, days, rounded = found.groups()
    moment = as_of + timedelta(days=int(days or 1) * {"+": 1, "-": -1, None: 0}[sign])
    return _midnight(moment) if rounded else moment


def _spec_column(tx: DataFrame, field: str) -> tuple[str, Column]:
    name = field.removesuffix(".keyword")
    return name, F.col(name)


def _spec_filter(tx: DataFrame, clause: dict, as_of: datetime) -> Column:
    (kind, body), = clause.items()
    (field, wanted), = body.items()
    name, column = _spec_column(tx, field)
    if kind == "terms":
        return column.isin(*wanted)
    if kind == "range":
        compare = {"gte": column.__ge__, "gt": column.__gt__, "lte": column.__le__, "lt": column.__lt__}
        return reduce(and_, [compare[op](_instant(tx, name, _resolve(v, as_of))) for op, v in wanted.items()])
    raise ValueError(f"unsupported clause: {kind}")


def scan_from_spec(tx: DataFrame, spec: dict, as_of: datetime, ordered: bool = False) -> DataFrame:
    """The same scan from a stored search: ``must`` clauses of ``terms`` and ``range``, ``sort``."""
    body = spec["query_body"]
    clauses = body["query"]["bool"]["must"]
    rows = tx.filter(reduce(and_, [_spec_filter(tx, c, as_of) for c in clauses]))
    if not ordered:
        return rows
    keys = [(_spec_column(tx, f)[1], o["order"]) for s in body.get("sort", []) for f, o in s.items()]
    return rows.orderBy(*[c.desc() if o == "desc" else c.asc() for c, o in keys]) if keys else rows


def scan_with_model_fallback(
    tx: DataFrame, deployments: DataFrame, deployment_id: int, as_of: datetime,
    days_back: int = DAYS_BACK, model_id: int | None = None,
) -> DataFrame:
    """Rows of the wanted model; without any, rows of the deployment's own model; else all rows.

    One plan: "has the model any row" and "the deployment's model" are scalar subqueries.
    """
    rows = scan_transactions(tx, deployment_id, as_of, days_back)
    if model_id is None:
        return rows
    model = nested(tx, "model_id")
    has_rows = rows.agg(F.coalesce(F.bool_or(model == model_id), F.lit(False))).scalar()
    own = (
        deployments.filter(F.col("deployment_id") == deployment_id)
        .agg(F.max("model_id")).scalar()
    )
    differs = own.isNotNull() & (own != 0) & (own != model_id)
    return rows.filter(
        F.when(has_rows, model == model_id).when(differs, model == own).otherwise(F.lit(True))
    )


def _undeclared(text: Column, schema: T.StructType, typed: bool) -> Column:
    """Keys of a JSON object that the schema does not name, with their values as variants or as JSON text."""
    declared = [f.name for f in schema.fields]
    return F.map_filter(F.from_json(text, f"map<string,{'variant' if typed else 'string'}>"), lambda k, _: ~k.isin(declared))


def flatten_transactions(
    tx: DataFrame, data_schema: T.StructType = TRANSACTION_DATA, other_keys: str | None = None, typed: bool = False,
) -> DataFrame:
    """Spread ``transaction_data`` (else ``metric_data``) into columns, time columns first.

    A struct is spread as it is; JSON text is parsed with the declared schema.  On a name
    clash the outer column keeps its name and the inner one is prefixed.  With ``other_keys`` the
    keys of JSON text that the schema does not declare are kept in a map column of that name: as text, or with ``typed`` as
    variants, which keep numbers, lists and nested objects as they are.
    """
    if "_source" in tx.columns:
        tx = tx.select("_source.*")
    inner = next((n for n in ("transaction_data", "metric_data") if n in tx.columns), None)
    outer = [c for c in tx.columns if c != inner]
    times = [c for c in ("transaction_start_time", "transaction_end_time") if c in outer]
    if len(times) == 2:
        outer = times + [c for c in outer if c not in times]
    if inner is None:
        return tx.select(*outer)
    if isinstance(tx.schema[inner].dataType, T.StringType):
        # flags come as true/false or as 1/0: read as text, then judged
        flags = [f.name for f in data_schema.fields if isinstance(f.dataType, T.BooleanType)]
        as_text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in flags else f for f in data_schema.fields])
        tx = tx.withColumns({"_json": F.col(inner), inner: F.from_json(F.col(inner), as_text)})
        for name in flags:
            said = F.lower(F.col(inner)[name])
            tx = tx.withColumn(inner, F.col(inner).withField(name, F.when(said.isin("true", "1", "1.0"), True).when(said.isin("false", "0", "0.0"), False)))
        if other_keys:
            tx = tx.withColumn(inner, F.col(inner).withField(other_keys, _undeclared(F.col("_json"), data_schema, typed)))
    fields = [f.name for f in tx.schema[inner].dataType.fields]
    return tx.select(
        *outer,
        *[F.col(f"{inner}.{f}").alias(f"{inner}_{f}" if f in outer else f) for f in fields],
    )


def normalize_times(tx: DataFrame) -> DataFrame:
    """Start and end to whole seconds (unparsable text to NULL), ``Date`` and ``time`` to dates."""
    columns = {}
    for name in ("transaction_start_time", "transaction_end_time"):
        if name in tx.columns:
            moment = F.col(name).try_cast("timestamp_ntz")
            # by seconds, not date_trunc: that goes through the session's time zone
            seconds = F.extract(F.lit("SECOND"), moment)
            columns[name] = moment - F.make_dt_interval(secs=seconds - F.floor(seconds))
    if "time" in tx.columns:
        columns["time"] = F.col("time").try_cast("date") if isinstance(
            tx.schema["time"].dataType, T.StringType) else F.to_date("time")
    tx = tx.withColumns(columns) if columns else tx
    return tx.withColumn("Date", F.to_date(_START)) if _START in tx.columns else tx
