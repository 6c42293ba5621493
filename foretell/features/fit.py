"""Fit a feature specification on training rows and apply it to any rows."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml.feature import Interaction, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from foretell.features import columns as C
from foretell.features.spec import HISTORY_OPS, TEXT_OPS, FeatureSpec
from foretell.features.text import TextVectors, VectorVocabulary, fit_text_op, sparse_vector, vocabulary
from foretell.features.topics import TopicShares
from foretell.operators.history import delayed_history, sponsors_from_list
from foretell.operators.ordinal import exact_quantiles, global_ordinal
from foretell.operators.splits import TRAIN, VALIDATION, block_slice
from foretell.session import cut_lineage, scratch_path
from foretell.sources.tables import qualified

MAX_CATEGORIES = 10_000
#: Text models whose vectors are made by joins.
_JOINED = (TextVectors, TopicShares)
_DAYS = {
    "time_since_session_start": C.since_session_start,
    "time_till_session_end": C.till_session_end,
}
_IMPUTED = ("impute_mean", "impute_median")
COLUMN_OPS = (
    *_DAYS, *HISTORY_OPS, *TEXT_OPS, *_IMPUTED, "impute_fixed", "mark_blanks", "one_hot", "normalize",
    "one_hot_table", "hash_column",
)


def _history_column(key: str) -> str:
    return f"__hist_{key}"


def with_history(
    df: DataFrame, spec: FeatureSpec, population: DataFrame | None = None
) -> DataFrame:
    """``df`` with the sponsor history columns the specification asks for, joined by id.

    ``population``, if given, contains the rows of ``df`` and all others that count.
    Columns that are there already are left alone.
    """
    joined = df
    done: dict[tuple, DataFrame] = {}
    wanted = [
        (key, op, (spec.column_of(key), *ops[op])) for key, ops in spec.ops.items()
        for op in HISTORY_OPS if op in ops and _history_column(key) not in df.columns
    ]
    for key, op, source in wanted:
        if source not in done:
            listed, day, status = source

            def facts(rows: DataFrame) -> DataFrame:
                return rows.select(
                    F.col(spec.id_column).alias("bill_id"),
                    F.col(day).alias("introduced_date"), F.col(status).alias("status_new"),
                )

            # lists are dealt by id while they are packed, and meet the dates where they are unpacked
            everyone = (df if population is None else population).select(spec.id_column, listed).repartition(spec.id_column)
            found = delayed_history(
                facts(df), sponsors_from_list(everyone, spec.id_column, listed),
                None if population is None else facts(population),
            )
            found = found.withColumnRenamed("bill_id", spec.id_column)
            # several columns of one history read it once computed
            done[source] = cut_lineage(found) if sum(s == source for *_, s in wanted) > 1 else found
        values = done[source].select(spec.id_column, F.col(op).alias(_history_column(key)))
        joined = joined.join(values, spec.id_column, "left")
    return joined


def _categories(df: DataFrame, expr: Column, key: str) -> list:
    found = df.select(expr.alias("v")).where("v is not null").distinct()
    rows = found.orderBy("v").limit(MAX_CATEGORIES + 1).collect()
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(
            f"{key} has over {MAX_CATEGORIES} categories, too many for one column each: "
            "use one_hot_table, one_hot_long or hash_column"
        )
    return [r.v for r in rows]


def _table_categories(df: DataFrame, params) -> list:
    column, table, schema = params
    source = df.sparkSession.table(qualified(schema, table))
    return _categories(source, F.col(column), f"{schema}.{table}.{column}")


def _category_table(df: DataFrame, expr: Column) -> dict[str, Any]:
    """The distinct values as a written table ``(category, idx)``, alphabetical, for any number of them."""
    found = df.select(expr.alias("category")).where("category is not null").distinct()
    path = scratch_path(df.sparkSession, "categories")
    global_ordinal(cut_lineage(found), ["category"], "idx").withColumn("idx", F.col("idx") - 1).write.parquet(path)
    return {"path": path, "n_features": df.sparkSession.read.parquet(path).count()}


def _from_table(params) -> bool:
    return isinstance(params, list) and bool(params) and params[0] == "##from_db"


def vector_entries(vector: Column | str) -> Column:
    """``array<struct<at: int, value: double>>`` of a vector's stored entries, without unpacking a sparse one."""
    inner = F.unwrap_udt(F.col(vector) if isinstance(vector, str) else vector)
    entry = lambda at, value: F.struct(at.cast("int").alias("at"), value.alias("value"))
    sparse = F.zip_with(inner["indices"], inner["values"], entry)
    dense = F.transform(inner["values"], lambda value, at: entry(at, value))
    return F.when(inner["type"] == 0, sparse).otherwise(dense)


def _moved_entries(vector: str, offset: int) -> Column:
    """The entries of a vector that are not zero, as part of a longer one."""
    given = F.filter(vector_entries(vector), lambda e: e["value"] != 0)
    return F.transform(given, lambda e: F.struct((e["at"] + offset).cast("int").alias("at"), e["value"].alias("value")))


@dataclass
class _Chain:
    """A feature while it is fitted: its expression so far and the operations with fitted values."""

    key: str
    expr: Column
    todo: list[tuple[str, Any]]
    applied: list[tuple[str, Any]] = field(default_factory=list)

    def take(self, op: str, params) -> None:
        self.todo.pop(0)
        self.applied.append((op, params))
        if op in _DAYS:
            self.expr = _DAYS[op](self.expr, F.col(params[0]))
        elif op in HISTORY_OPS:
            self.expr = F.col(_history_column(self.key))
        elif op == "impute_fixed":
            self.expr = C.impute(self.expr, params)
        elif op == "mark_blanks":
            self.expr = C.mark_blanks(self.expr)[0]
        elif op == "normalize":
            self.expr = C.normalize(self.expr, *params)


def _is_open(op: str, params) -> bool:
    """Whether the operation still needs a value from the training rows."""
    if op in _IMPUTED:
        return True
    if op == "normalize":
        return not params
    return op in ("one_hot", "one_hot_table") and (not params or params == "auto")


def _number(value) -> float | None:
    return None if value is None or (isinstance(value, float) and math.isnan(value)) else value


def _fit_round(df: DataFrame, chains: list[_Chain]) -> None:
    """Resolve the next open operation of every chain from one aggregation.

    A normalisation or one-hot right after an imputation is read off the unfilled column:
    the fill value only joins the range or the categories if something was missing.
    """
    wanted, medians = {}, {}
    for i, chain in enumerate(chains):
        x = chain.expr
        op = chain.todo[0][0]
        if op == "impute_mean":
            wanted[f"mean_{i}"] = F.avg(x)
        elif op == "impute_median":
            medians[f"x_{i}"] = x.cast("double")
        if op not in ("one_hot", "one_hot_table"):
            wanted |= {f"low_{i}": F.min(x), f"high_{i}": F.max(x), f"null_{i}": F.count_if(x.isNull())}
    stats = df.agg(*[c.alias(n) for n, c in wanted.items()]).first().asDict() if wanted else {}
    if medians:
        base = df.select(*[c.alias(n) for n, c in medians.items()])
        for row in exact_quantiles(base, list(medians), [0.5]).collect():
            stats[f"median_{row.column[2:]}"] = row.value

    for i, chain in enumerate(chains):
        op = chain.todo[0][0]
        low, high = _number(stats.get(f"low_{i}")), _number(stats.get(f"high_{i}"))
        if op == "one_hot":
            chain.take("one_hot", _categories(df, chain.expr, chain.key))
            continue
        if op == "one_hot_table":
            chain.take("one_hot_table", _category_table(df, chain.expr))
            continue
        if op == "normalize":
            chain.take("normalize", (low, high))
            continue
        value = _number(stats.get(f"{op[7:]}_{i}"))
        value = 0 if value is None else value
        unfilled, missing = chain.expr, stats[f"null_{i}"] > 0
        chain.take("impute_fixed", value)
        if chain.todo and _is_open(*chain.todo[0]):
            following = chain.todo[0][0]
            if following == "normalize":
                if missing:
                    low = value if low is None else min(low, value)
                    high = value if high is None else max(high, value)
                chain.take("normalize", (low, high))
            elif following == "one_hot":
                seen = set(_categories(df, unfilled, chain.key)) | ({value} if missing else set())
                chain.take("one_hot", sorted(seen))


def _hash_parameters(params: Mapping[str, Any]) -> dict[str, Any]:
    """Buckets and sign of a hashed column; a parameter that has no meaning here is an error."""
    known = {"n_features": C.DEFAULT_BUCKETS, "input_type": "string", "alternate_sign": True}
    unknown = {k: v for k, v in params.items() if k not in (*known, "dtype")}
    if unknown or params.get("input_type", "string") != "string":
        raise ValueError(f"hash_column: {unknown or params} not available; n_features, alternate_sign and strings are")
    return known | {k: v for k, v in params.items() if k in known}


def _fixed(df: DataFrame, op: str, params):
    """Parameters of an operation that needs no training rows."""
    if op == "impute_fixed":
        return params if params not in ([], None, "") else 0
    if op == "one_hot":
        if isinstance(params, int):
            return list(range(params))
        return _table_categories(df, params[1]) if _from_table(params) else list(params)
    if op == "normalize":
        return tuple(params)
    if op == "one_hot_table" and _from_table(params):
        column, table, schema = params[1]
        return _category_table(df.sparkSession.table(qualified(schema, table)), F.col(column))
    if op == "hash_column":
        return _hash_parameters(params or {})
    return params


@dataclass(frozen=True)
class FittedFeatures:
    """A specification with every parameter filled in; ``applied`` can be read and stored."""

    spec: FeatureSpec
    applied: Mapping[str, list[tuple[str, Any]]]
    text_models: Mapping[str, tuple]
    label_type: str = "binary"

    def _outputs(self, key: str) -> tuple[list[tuple[str, Column]], tuple[dict, Column] | None]:
        """Named scalar columns of a feature, and ``(options, value)`` if it is hashed or looked up in a category table."""
        column = self.spec.column_of(key)
        chain = _Chain(key, F.col(column), list(self.applied[key]))
        name, extra = column, []
        while chain.todo:
            op, params = chain.todo[0]
            if op == "mark_blanks" and params:
                extra.append((f"{column}_is_null?", C.mark_blanks(chain.expr)[1].cast("double")))
            if op == "one_hot":
                hot = zip(params, C.one_hot(chain.expr, params))
                return [(f"{column}_{c}", e) for c, e in hot] + extra, None
            if op in ("one_hot_table", "hash_column"):
                return extra, (params, chain.expr)
            if op in _DAYS or op in HISTORY_OPS:
                name = op
            chain.take(op, params)
        return [(name, chain.expr.cast("double")), *extra], None

    def columns(self, df: DataFrame) -> DataFrame:
        """``(id, label, one double column per scalar feature)``, without text and hashes."""
        named = [o for k in self.applied if k not in self.text_models for o in self._outputs(k)[0]]
        return df.select(
            self.spec.id_column,
            C.label(self.spec.label_column, self.label_type).alias("label"),
            *[e.alias(n) for n, e in named],
        )

    def feature_names(self) -> list[str]:
        """Names by vector position, from the same rules that build the vector."""
        names: list[str] = []
        for key in self.applied:
            if key in self.text_models:
                names += [f"{self.spec.column_of(key)}::{t}" for t in self.text_models[key][2]]
                continue
            scalars, hashed = self._outputs(key)
            names += [n for n, _ in scalars]
            if hashed and "path" in hashed[0]:
                # as many names as the model has coefficients
                table = SparkSession.getActiveSession().read.parquet(hashed[0]["path"]).toArrow().sort_by("idx")
                names += [f"{self.spec.column_of(key)}_{c}" for c in table.column("category").to_pylist()]
            elif hashed:
                names += [f"{self.spec.column_of(key)}#{b}" for b in range(hashed[0]["n_features"])]
        return names

    def layout(self) -> dict[str, range]:
        """Positions of each feature key in the vector, fitted with it: what is dense and what a text fills."""
        places, start = {}, 0
        for key in self.applied:
            if key in self.text_models:
                size = len(self.text_models[key][2])
            else:
                named, hashed = self._outputs(key)
                size = len(named) + (hashed[0]["n_features"] if hashed else 0)
            places[key] = range(start, start + size)
            start += size
        return places

    def size(self) -> int:
        """Length of the vector."""
        return max((places.stop for places in self.layout().values()), default=0)

    def transform(self, df: DataFrame, population: DataFrame | None = None) -> DataFrame:
        """``(id, features, label)``; a missing feature value is an error."""
        rows = with_history(df, self.spec, population)
        scalars, hashes, lookups, models = [], [], [], []
        # runs of inputs that are assembled, and texts between them whose vectors are made by joins
        parts: list[tuple[int, list[str] | TextVectors | TopicShares]] = []
        places = self.layout()
        for i, key in enumerate(self.applied):
            model, out = self.text_models[key][:2] if key in self.text_models else (None, None)
            if isinstance(model, _JOINED):
                parts.append((places[key].start, model))
                continue
            if not parts or isinstance(parts[-1][1], _JOINED):
                parts.append((places[key].start, []))
            inputs = parts[-1][1]
            if model:
                models.append((self.spec.column_of(key), model))
                inputs.append(out)
                continue
            named, hashed = self._outputs(key)
            for j, (_, expr) in enumerate(named):
                scalars.append(expr.alias(f"__f{i}_{j}"))
                inputs.append(f"__f{i}_{j}")
            if hashed and "path" in hashed[0]:
                scalars.append(hashed[1].alias(f"__c{i}"))
                lookups.append((f"__c{i}", hashed[0], f"__h{i}"))
                inputs.append(f"__h{i}")
            elif hashed:
                options, value = hashed
                size = options["n_features"]
                bucket = C.hash_bucket(value, size).cast("double")
                # the declared size spares the encoder a pass over the data
                meta = {"ml_attr": {"type": "nominal", "num_vals": size, "name": f"__b{i}"}}
                scalars += [bucket.alias(f"__b{i}", metadata=meta), (C.hash_sign(value) if options["alternate_sign"] else F.lit(1.0)).alias(f"__s{i}")]
                hashes.append((f"__b{i}", f"__s{i}", f"__h{i}"))
                inputs.append(f"__h{i}")
        joined = [model for _, model in parts if isinstance(model, _JOINED)]
        texts = list(dict.fromkeys([c for c, _ in models] + [model.column for model in joined]))
        label = C.label(self.spec.label_column, self.label_type).alias("label")
        out = rows.select(self.spec.id_column, label, *texts, *scalars)
        for bucket, sign, vector in hashes:
            hot = OneHotEncoder(inputCols=[bucket], outputCols=[f"{bucket}_v"], dropLast=False)
            out = hot.fit(out).transform(out)
            out = Interaction(inputCols=[sign, f"{bucket}_v"], outputCol=vector).transform(out)
        for value, options, vector in lookups:
            size = options["n_features"]
            known = df.sparkSession.read.parquet(options["path"]).select(F.col("category").alias(f"{value}_k"), F.col("idx").alias(f"{value}_i"))
            # one place more, which the encoder leaves out: an unknown or missing value is all zeros
            meta = {"ml_attr": {"type": "nominal", "num_vals": size + 1, "name": value}}
            place = F.coalesce(f"{value}_i", F.lit(size)).cast("double").alias(f"{value}_p", metadata=meta)
            out = out.join(known, F.col(value) == F.col(f"{value}_k"), "left").select(*out.columns, place)
            hot = OneHotEncoder(inputCols=[f"{value}_p"], outputCols=[vector], dropLast=True)
            out = hot.fit(out).transform(out)
        for _, model in models:
            out = model.transform(out)
        runs = [part for _, part in parts if not isinstance(part, _JOINED)]
        for i, part in enumerate(runs):
            assemble = VectorAssembler(
                inputCols=list(dict.fromkeys(part)), outputCol="features" if not joined else f"__run{i}", handleInvalid="error"
            )
            out = assemble.transform(out)
        if not joined:
            return out.select(self.spec.id_column, "features", "label")
        return self._with_texts(out, parts, max(p.stop for p in places.values()))

    def _with_texts(self, rows: DataFrame, parts, size: int) -> DataFrame:
        """Assembled runs (``__run0`` on) and texts as one sparse vector per row, without a name for every place.

        Rows are written with a number, under which the entries of their texts come back.
        """
        key, runs, found = "__row", [], []
        for start, part in parts:
            if not isinstance(part, _JOINED):
                runs.append(_moved_entries(f"__run{len(runs)}", start).alias(f"__part{len(runs)}"))
        texts = list(dict.fromkeys(part.column for _, part in parts if isinstance(part, _JOINED)))
        rows = cut_lineage(rows.select(
            F.monotonically_increasing_id().alias(key), self.spec.id_column, "label",
            *[F.col(c).alias(f"__text_{c}") for c in texts], *runs,
        ))
        out = rows.drop(*[f"__text_{c}" for c in texts])
        none = F.lit([]).cast("array<struct<at:int,value:double>>")
        for start, part in parts:
            if isinstance(part, _JOINED):
                name = f"__text{len(found)}"
                entries = part.entries(rows.withColumnRenamed(f"__text_{part.column}", part.column), key, start)
                out = out.join(entries.withColumnRenamed("entries", name), key, "left")
            else:
                name = f"__part{len(found) - len([n for n in found if n.startswith('__text')])}"
            found.append(name)
        all_entries = F.concat(*[F.coalesce(name, none) for name in found])
        path = scratch_path(rows.sparkSession, "vectors")
        stored = out.select(self.spec.id_column, sparse_vector(all_entries, size).alias("features"), "label")
        stored.write.parquet(path)
        kinds = {f.name: f for f in stored.schema.fields}
        schema = StructType([StructField("features", VectorUDT()) if n == "features" else f for n, f in kinds.items()])
        return rows.sparkSession.read.schema(schema).parquet(path)


def fit_features(
    train: DataFrame, spec: FeatureSpec, label_type: str = "binary",
    vocab: VectorVocabulary | None = None, population: DataFrame | None = None,
) -> FittedFeatures:
    """Fit every operation on ``train``.

    ``vocab`` holds the terms of the text columns, usually built from all rows; without
    one it is built from ``train``.
    """
    for key, ops in spec.ops.items():
        unknown = [op for op in ops if op not in COLUMN_OPS]
        if unknown:
            raise ValueError(f"{key}: unknown operations {unknown}, choose from {COLUMN_OPS}")
    rows = with_history(train, spec, population)
    chains, text_models, applied = [], {}, {}
    if spec.text_columns() and vocab is None:
        vocab = VectorVocabulary(vocabulary(train, spec.text_columns()))
    for key, ops in spec.ops.items():
        column = spec.column_of(key)
        text_op = next((op for op in ops if op in TEXT_OPS), None)
        if text_op:
            tag = f"t{len(text_models)}"
            text_models[key] = fit_text_op(train, column, text_op, ops[text_op], vocab, tag)
            applied[key] = [(text_op, ops[text_op])]
            continue
        chain = _Chain(key, F.col(column), list(ops.items()))
        chains.append(chain)
        applied[key] = chain.applied
    waiting = chains
    while waiting:
        for chain in waiting:
            while chain.todo and not _is_open(*chain.todo[0]):
                op, params = chain.todo[0]
                chain.take(op, _fixed(train, op, params))
        waiting = [c for c in waiting if c.todo]
        if waiting:
            _fit_round(rows, waiting)
    return FittedFeatures(spec, applied, text_models, label_type)


def block_features(
    facts: DataFrame, spec: FeatureSpec, block_id: int, label_type: str = "binary",
    vocab: VectorVocabulary | None = None, history: str = "slice",
) -> tuple[FittedFeatures, DataFrame, DataFrame]:
    """Fitted features with the training and validation tables of one block.

    ``history="slice"`` draws sponsor history from the slice itself, ``"all"`` from every row.
    """
    if history not in ("slice", "all"):
        raise ValueError(f"history {history!r}, choose from slice, all")
    read = spec.columns(block_id)

    def kept(described: DataFrame) -> DataFrame:
        """Written with the columns that the specification reads and those that its history added."""
        return cut_lineage(described.select([c for c in described.columns if c in read or c not in facts.columns]))

    source = facts
    if history == "all":
        described = with_history(facts, spec)
        if described is not facts:
            # the fit and both slices read it, so history is computed once and kept
            source = kept(described)
    slices = [block_slice(source, block_id, role) for role in (TRAIN, VALIDATION)]
    if history == "slice" and spec.has_history():
        # fit and apply both read the slice, so its history is computed once and kept
        slices = [kept(with_history(rows, spec)) for rows in slices]
    train, valid = slices
    fitted = fit_features(train, spec, label_type, vocab)
    return fitted, fitted.transform(train), fitted.transform(valid)


def one_hot_frame(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every listed column label-encoded alphabetically and one-hot encoded into one vector."""
    indexed = [f"__i_{c}" for c in columns]
    hot = [f"__h_{c}" for c in columns]
    index = StringIndexer(inputCols=columns, outputCols=indexed, stringOrderType="alphabetAsc")
    out = index.fit(df).transform(df)
    out = OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=False).fit(out).transform(out)
    out = VectorAssembler(inputCols=hot, outputCol="one_hot").transform(out)
    return out.drop(*indexed, *hot)
