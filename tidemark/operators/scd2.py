"""Slowly changing dimensions, type 2: each change closes a row and opens the next version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import dense_keys
from tidemark.operators.dedup import keep_best
from tidemark.session import new_folder
from tidemark.sources.tables import absent_from


@dataclass(frozen=True)
class Dimension:
    """What a type-2 dimension is made of.

    ``starts`` names the source column with the first day of a key's first version;
    without it, or where it is null, that is the day of the load. ``carried`` columns
    are copied from the source but are no reason for a new version. ``defaults`` are SQL
    values that stand for missing attributes. ``same_day`` says what happens to a
    version that changes on the day it began: 'close' ends it before it starts and opens
    another one, 'replace' changes it in place, so that a key and a first day stay unique.
    """

    key: str
    attributes: tuple[str, ...]
    surrogate: str
    since: str = "effective_date"
    until: str = "end_date"
    starts: str | None = None
    carried: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, str] = field(default_factory=dict)
    same_day: str = "replace"

    def columns(self) -> list[str]:
        return [self.surrogate, self.key, *self.attributes, self.since, self.until, "is_current", *self.carried]

    def incoming(self, source: DataFrame) -> DataFrame:
        """A source's rows as ``_key``, ``_new_<attribute>``, ``_starts`` and ``_new_<carried>``."""
        values = {a: f"coalesce({a}, {self.defaults[a]})" if a in self.defaults else a for a in self.attributes}
        return source.selectExpr(
            f"{self.key} AS _key",
            *[f"{value} AS _new_{name}" for name, value in values.items()],
            f"CAST({self.starts or 'NULL'} AS DATE) AS _starts",
            *[f"{column} AS _new_{name}" for name, column in self.carried.items()],
        )


USERS = Dimension(
    key="user_id",
    attributes=("full_name", "email", "phone", "city", "country", "is_active"),
    surrogate="user_sk",
    since="effective_from",
    until="effective_to",
    starts="created_date",
    carried={"_silver_batch": "_source_batch_id"},
    defaults={"is_active": "false"},
    same_day="close",
)
CUSTOMERS = Dimension(
    key="customer_id",
    attributes=(
        "customer_name",
        "email",
        "phone",
        "full_address",
        "city",
        "state",
        "zip_code",
        "region",
        "customer_type",
        "business_type",
        "credit_limit",
        "registration_date",
        "status",
    ),
    surrogate="customer_key",
)
PRODUCTS = Dimension(
    key="product_id",
    attributes=(
        "product_name",
        "description",
        "category",
        "subcategory",
        "brand",
        "unit_price",
        "unit_cost",
        "currency",
        "status",
    ),
    surrogate="product_key",
)


def one_row_per_key(
    source: DataFrame, key: str, repeated: str = "reduce", best_first: Sequence[Column] | None = None
) -> DataFrame:
    """The source with each key once; rows without a key have no identity and stay out.

    'reduce' keeps the first row of a key in the given order, by default the order of all
    columns from the highest value down; 'refuse' raises an error that names a repeated key.
    """
    known = source.filter(F.col(key).isNotNull())
    if repeated == "reduce":
        order = best_first or [F.col(name).desc_nulls_last() for name in source.columns]
        return keep_best(known, [key], order)
    if repeated != "refuse":
        raise ValueError(f"unknown rule for repeated keys: {repeated}")
    twice = known.groupBy(key).count().filter("count > 1").first()
    if twice is not None:
        raise ValueError(f"{key} {twice[0]} stands in {twice[1]} source rows")
    return known


def empty_dimension(source: DataFrame, kind: Dimension) -> DataFrame:
    """A dimension without rows, typed by its source."""
    types = {f.name: f.dataType for f in kind.incoming(source).schema}
    made = {
        kind.surrogate: T.LongType(),
        kind.key: types["_key"],
        **{name: types[f"_new_{name}"] for name in kind.attributes},
        kind.since: T.DateType(),
        kind.until: T.DateType(),
        "is_current": T.BooleanType(),
        **{name: types[f"_new_{name}"] for name in kind.carried},
    }
    schema = T.StructType([T.StructField(name, made[name]) for name in kind.columns()])
    return source.sparkSession.createDataFrame([], schema)


def scd2_changes(
    dim: DataFrame,
    source: DataFrame,
    as_of: date,
    kind: Dimension = USERS,
    repeated: str = "reduce",
    best_first: Sequence[Column] | None = None,
    revive: bool = False,
) -> DataFrame:
    """The next state of the dimension, each row marked in ``_action``:
    'kept', 'closed', 'replaced', 'reopened' or 'new'.

    Only current rows meet the source, in one join, and a changed row leaves it as its
    closed form and its next version; closed rows pass by. A left join lets AQE split a hot
    key, and the check for unseen keys compares against distinct keys only. Versions
    that open are numbered above all stored ones (``dense_keys``), so that surrogates stay
    unique whatever the natural keys are, and rows that stay keep theirs.

    A key missing from the source stays as it is. A key with closed versions only is
    left alone, or opened again with ``revive``. Running the same source again changes
    nothing.
    """
    today = f"DATE'{as_of.isoformat()}'"
    incoming = kind.incoming(one_row_per_key(source, kind.key, repeated, best_first))
    dim = dim.select(*kind.columns())
    current = dim.filter("is_current")
    past = dim.filter("NOT coalesce(is_current, false)").withColumn("_action", F.lit("kept"))
    differs = " OR ".join(f"NOT ({name} <=> _new_{name})" for name in kind.attributes)
    in_place = f"{kind.since} = {today}" if kind.same_day == "replace" else "false"
    joined = current.join(incoming, F.col(kind.key) == F.col("_key"), "left").withColumns(
        {
            "_changed": F.expr(f"_key IS NOT NULL AND ({differs})"),
            "_in_place": F.expr(in_place),
        }
    )
    taken = {name: f"_new_{name}" for name in (*kind.attributes, *kind.carried)}
    kept = _version(kind, _action="'kept'")
    replaced = _version(kind, **taken, _action="'replaced'")
    closed = _version(kind, **{kind.until: f"{today} - 1"}, is_current="false", _action="'closed'")
    opened = {
        **taken,
        kind.surrogate: "CAST(NULL AS BIGINT)",
        kind.until: "CAST(NULL AS DATE)",
        "is_current": "true",
    }
    reopened = _version(kind, **{**opened, kind.since: today}, _action="'reopened'")
    existing = joined.selectExpr(
        f"inline(CASE WHEN NOT _changed THEN array({kept}) WHEN _in_place THEN array({replaced}) "
        f"ELSE array({closed}, {reopened}) END)"
    )
    known = (current if revive else dim).select(F.col(kind.key).alias("_key"))
    unseen = absent_from(incoming, known, ["_key"])
    first = {**opened, kind.key: "_key", kind.since: f"coalesce(_starts, {today})"}
    new = unseen.selectExpr(f"inline(array({_version(kind, **first, _action=repr('new'))}))")

    # The join is computed once: what it decides is stored before the open versions are numbered.
    spark, path = dim.sparkSession, new_folder(dim.sparkSession, f"changes-{kind.surrogate}")
    decided = existing.unionByName(new)
    decided.write.parquet(path)
    stored = spark.read.schema(decided.schema).parquet(path)
    fresh = stored.filter(F.col(kind.surrogate).isNull())
    numbered = dense_keys(fresh, kind.surrogate, [kind.key], after=dim)
    others = stored.filter(F.col(kind.surrogate).isNotNull())
    return past.unionByName(others).unionByName(numbered)


def _version(kind: Dimension, **replaced: str) -> str:
    """A dimension row as a struct with some columns replaced, ``_action`` last."""
    columns = (*kind.columns(), "_action")
    return "struct(" + ", ".join(f"{replaced.get(c, c)} AS {c}" for c in columns) + ")"


def scd2_upsert(dim: DataFrame, source: DataFrame, as_of: date, **options) -> DataFrame:
    """Next state of the dimension; store it beside the one read, then swap."""
    return scd2_changes(dim, source, as_of, **options).drop("_action")


def scd2_init(source: DataFrame, as_of: date, kind: Dimension = USERS, **options) -> DataFrame:
    """First load: every key's row is current since its own start (or the load)."""
    rows = kind.incoming(one_row_per_key(source, kind.key, **options)).selectExpr(
        "_key AS " + kind.key,
        *[f"_new_{name} AS {name}" for name in kind.attributes],
        f"coalesce(_starts, DATE'{as_of.isoformat()}') AS {kind.since}",
        f"CAST(NULL AS DATE) AS {kind.until}",
        "true AS is_current",
        *[f"_new_{name} AS {name}" for name in kind.carried],
    )
    return dense_keys(rows, kind.surrogate, [kind.key])


def scd2_stats(changes: DataFrame) -> DataFrame:
    """How many rows the upsert closed and how many keys it saw first."""
    return changes.agg(
        F.count_if(F.col("_action") == "closed").alias("changed_count"),
        F.count_if(F.col("_action") == "new").alias("new_count"),
    )


def history(dim: DataFrame, key: str, value: object = None) -> DataFrame:
    """Versions in order of effect, of one key or of every key."""
    rows = dim if value is None else dim.filter(F.col(key) == value)
    since = "effective_from" if "effective_from" in dim.columns else "effective_date"
    return rows.orderBy(key, since, "is_current")
