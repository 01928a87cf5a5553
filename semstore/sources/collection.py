"""A collection as a table in the Spark catalog: a base in Parquet, and the changes since it was last rewritten.

A change costs as much as the change: upserts and deletions are written next to the base, each into a directory of
its own. A commit, a small file, names the directories that count; making it is one step, so a writer that dies leaves
nothing half done. Of two writers one makes the next commit and the other tries again: what it has written is put after
the other's if it does not depend on what was there, else it is made anew. Reading puts the newest change of an id in
place of its base record; ``compact`` rewrites the base; many changes are folded into one now and then.

Newest means committed last, or, if the collection names a ``version`` field, the greatest version: then changes may
arrive in any order, in one batch or over many. Deletions remove what was committed before them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from typing import Any

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semstore.errors import ConflictError, RecordError
from semstore.functions import text as texts
from semstore.functions import vectors
from semstore.operators import cells, counts, quality, recommend, records, search, shred, store
from semstore.operators.embed import Provider
from semstore.operators.knn import search_batch
from semstore.operators.filters import is_empty, predicate
from semstore.plans import arguments, sizing, workspace
from semstore.sources.commits import Commits, State

_PROPERTY = "semstore."
_NORM, _CELL, _REACH = "_norm", "_cell", "_reach"
_HIDDEN = (_NORM, _CELL, _REACH)
#: How often a change is tried when others commit in between.
_ATTEMPTS = 20


class Collection:
    """Records ``id, vector`` and payload columns, with one dimension and one metric."""

    def __init__(self, spark: SparkSession, name: str | None = None) -> None:
        self.spark = spark
        self.name = arguments.collection_name(name)
        if not self.exists(spark, self.name):
            raise RecordError(f"there is no collection {self.name!r}")
        properties = self._properties()
        self.dim = int(properties["dim"])
        self.metric = properties["metric"]
        self.root = properties["root"]
        self.compact_after = int(properties["compact_after"])
        self.version = properties.get("version") or None
        self._commits = Commits(spark, self.root)
        self._known_cells: tuple[str, cells.Cells] | None = None
        self.schema = spark.table(self._quoted).schema

    # --- lifecycle

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        name: str | None,
        size: int,
        distance: str = "cosine",
        *,
        payload: T.StructType | str | None = None,
        root: str | None = None,
        compact_after: int = 50,
        version: str | None = None,
    ) -> Collection:
        """Make an empty collection. ``payload`` declares typed fields; all others go into a VARIANT column.

        ``version`` names the declared field whose greatest value is the newest version of a record.
        """
        if not name:
            raise RecordError("a collection needs a name")
        if isinstance(size, bool) or not isinstance(size, int) or size <= 0:
            raise RecordError("the vector size must be a positive integer")
        metric = vectors.check_metric(distance)
        if cls.exists(spark, name):
            raise RecordError(f"the collection {name!r} exists already")
        declared = T.StructType.fromDDL(payload) if isinstance(payload, str) else payload or T.StructType()
        schema = T.StructType(
            [T.StructField("id", T.StringType()), T.StructField("vector", T.ArrayType(T.DoubleType()))]
            + [f for f in declared.fields if f.name != "payload"]
            + [T.StructField("payload", T.VariantType()), T.StructField(_NORM, T.DoubleType())]
            + [T.StructField(_CELL, T.IntegerType()), T.StructField(_REACH, T.DoubleType())]
        )
        if version is not None and version not in declared.names:
            raise RecordError(f"the version {version!r} is not a declared payload field")
        root = root or workspace.new_path(spark, name)
        base = f"{root}/base-{uuid.uuid4().hex[:8]}"
        spark.createDataFrame([], schema).write.parquet(base)
        if not Commits(spark, root).publish(State(base), 1):
            raise RecordError(f"there is a collection at {root} already")
        properties = {"dim": size, "metric": metric, "root": root, "compact_after": compact_after, "version": version or ""}
        pairs = ", ".join(f"'{_PROPERTY}{k}' = '{_escaped(v)}'" for k, v in properties.items())
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {_quote(name)} ({fields}) USING parquet "
            f"LOCATION '{_escaped(base)}' TBLPROPERTIES ({pairs})"
        )
        return cls(spark, name)

    @staticmethod
    def exists(spark: SparkSession, name: str | None = None) -> bool:
        return spark.catalog.tableExists(_quote(arguments.collection_name(name)))

    @staticmethod
    def drop(spark: SparkSession, name: str) -> None:
        """Forget a collection and delete its files; one that does not exist is an error."""
        coll = Collection(spark, name)
        paths = [*coll._files(coll._state()), coll._commits.folder]
        spark.sql(f"DROP TABLE {_quote(name)}")
        for path in paths:
            workspace.remove(spark, path)

    def describe(self) -> DataFrame:
        return counts.describe(self.read(), self.name, self.dim, self.metric)

    @property
    def _quoted(self) -> str:
        return _quote(self.name)

    def _properties(self) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self._quoted}").collect()
        return {r["key"].removeprefix(_PROPERTY): r["value"] for r in rows if r["key"].startswith(_PROPERTY)}

    # --- reading

    def _state(self) -> State:
        return self._commits.last()

    def done(self, name: str) -> str | None:
        """A property that was committed together with a change, such as the last batch of a stream."""
        return self._state().properties.get(name)

    def _change_names(self) -> list[str]:
        """The folders of the changes that count, oldest first."""
        return self._state().folders

    def _base_path(self) -> str:
        return self._state().base

    def _change_path(self, folder: str) -> str:
        return f"{self.root}/change-{folder}"

    def _fields(self, state: State) -> list[T.StructField]:
        """The columns of the files: those of the table, and those of promoted payload fields."""
        return [*self.schema.fields, *shred.schema(state.promoted)]

    def _base(self, state: State, files: Sequence[str] | None = None) -> DataFrame:
        """The base, or some files of it."""
        paths = [state.base] if files is None else [f"{state.base}/{name}" for name in files]
        reader = self.spark.read.schema(T.StructType(self._fields(state)))
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], T.StructType(self._fields(state)))

    def _changes(self, state: State) -> DataFrame:
        """The rows of the changes, with ``_deleted`` and the place of their change (``_seq``, from 1)."""
        folders = state.folders
        reader = self.spark.read.schema(T.StructType([*self._fields(state), T.StructField("_deleted", T.BooleanType())]))
        rows = reader.parquet(*map(self._change_path, folders))
        number = F.create_map(*[F.lit(x) for i, folder in enumerate(folders, 1) for x in (folder, i)])
        name = F.regexp_extract(F.col("_metadata.file_path"), "/change-([0-9a-f]+)/[^/]*$", 1)
        return rows.select("*", F.element_at(number, name).alias("_seq"))

    def _current(self, state: State | None = None, files: Sequence[str] | None = None) -> DataFrame:
        """The records with all columns; of the base, only those in some files if they are given."""
        state = state or self._state()
        base = self._base(state, files)
        if not state.changes:
            return base
        changes = self._changes(state)
        # The size of the changed ids was measured when they were written: up to a limit they go to the base.
        ids = changes.select("id").distinct()
        ids = F.broadcast(ids) if state.change_bytes <= sizing.RESULT_BROADCAST_BYTES else ids
        untouched = base.join(ids, "id", "left_anti")
        if self.version:
            before = base.join(ids, "id", "left_semi").withColumns({"_deleted": F.lit(False), "_seq": F.lit(0)})
            newest = self._newest(before.unionByName(changes))
        else:
            newest = records.latest(changes, [F.col("_seq").desc()]).where(~F.col("_deleted"))
        return untouched.unionByName(newest.select(*base.columns))

    def _newest(self, rows: DataFrame) -> DataFrame:
        """Of the records committed after the last deletion of their id, the one with the greatest version."""
        gone = F.max(F.when(F.col("_deleted"), F.col("_seq"))).over(Window.partitionBy("id"))
        alive = rows.withColumn("_gone", gone).where(~F.col("_deleted") & (F.col("_seq") > F.coalesce("_gone", F.lit(-1))))
        return records.latest(alive, [F.col(f"`{self.version}`").desc_nulls_last(), F.col("_seq").desc()])

    def read(self) -> DataFrame:
        """The records as they are now."""
        return self._shown(self._current())

    def _shown(self, rows: DataFrame, *kept: str) -> DataFrame:
        """Records without the hidden columns."""
        return rows.select(*[f"`{c}`" for c in rows.columns if c in kept or c in self.schema.names and c not in _HIDDEN])

    # --- writing

    def _commit(self, change: DataFrame | Callable[[DataFrame], DataFrame], **properties: Any) -> None:
        """Write a change (with ``_deleted``) to a directory of its own, then let it count.

        A change given as a function of the current records is made anew if others commit in between.
        """
        written = None
        for _ in range(_ATTEMPTS):
            state = self._state()
            made_for = (state.cells, state.promoted)
            if written is None or written[2] != made_for or callable(change):
                rows = change(self._current(state)) if callable(change) else change
                written = (*self._written(rows, state), made_for)
            folder, size, _ = written
            if not size and not properties:
                return
            if self._commits.publish(state.with_change(folder, size, properties), state.number + 1):
                break
        else:
            raise ConflictError(f"other writers kept changing {self.name!r}")
        if len(state.changes) + 1 >= self.compact_after:
            self.compact() if self.version else self._fold()

    def _written(self, change: DataFrame, state: State) -> tuple[str, int]:
        """Write the rows of a change; its folder, and the bytes of its ids (0: no rows)."""
        aligned = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields if f.name in change.columns]
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields if f.name not in change.columns]
        rows = change.select(*aligned, *missing, "_deleted")
        if state.cells and "vector" in change.columns:
            rows = self._in_cells(rows, state)
        rows = rows.withColumns(shred.columns(state.promoted)) if state.promoted else rows
        folder = uuid.uuid4().hex[:8]
        rows.select(*[f.name for f in self._fields(state)], "_deleted").write.parquet(self._change_path(folder))
        ids = self.spark.read.schema("id string").parquet(self._change_path(folder))
        return folder, ids.agg(F.coalesce(F.sum(F.octet_length("id") + 32), F.lit(0))).first()[0]

    def _replace(self, make: Callable[[State], tuple[tuple, dict]]) -> State:
        """Commit other files in place of those of a state; what others commit meanwhile stays."""
        seen = self._state()
        changes, values = make(seen)
        for _ in range(_ATTEMPTS):
            state = self._state()
            if state.base != seen.base:
                raise ConflictError(f"{self.name!r} was rewritten by another writer")
            merged = state.instead_of(seen, changes, **values)
            if self._commits.publish(merged, state.number + 1):
                return seen
        raise ConflictError(f"other writers kept changing {self.name!r}")

    def _fold(self) -> None:
        """Put the newest change of every id into one change; the base and what has been read stay as they are."""

        def make(seen: State) -> tuple[tuple, dict]:
            folder = uuid.uuid4().hex[:8]
            folded = records.latest(self._changes(seen), [F.col("_seq").desc()])
            folded.drop("_seq").write.parquet(self._change_path(folder))
            return ((folder, seen.change_bytes),), {"old": (*seen.old, *seen.folders)}

        self._replace(make)

    def _files(self, state: State) -> list[str]:
        cells_ = [state.cells] if state.cells else []
        return [state.base, *map(self._change_path, [*state.old, *state.folders]), *cells_]

    def compact(self) -> None:
        """Write the current records as the new base, ordered by id, and delete what it replaces.

        A crash half-way changes no result. Results read before are gone with their files. Once the collection has
        cells, records are ordered by cell first.
        """
        self._rewrite(lambda state: (self._current(state), state))

    def promote(self, *fields: str) -> None:
        """Give undeclared payload fields columns of their own, and rewrite the base: filters on them reach the scan."""
        names = shred.check_fields(fields)
        if taken := [n for n in names if n in self.schema.names]:
            raise RecordError(f"declared already: {', '.join(taken)}")

        def promoted(state: State) -> tuple[DataFrame, State]:
            every = tuple(dict.fromkeys((*state.promoted, *names)))
            return self._current(state).withColumns(shred.columns(every)), replace(state, promoted=every)

        self._rewrite(promoted)

    def _rewrite(self, make: Callable[[State], tuple[DataFrame, State]]) -> None:
        """Write a new base; ``make`` gives its rows and a state with the cells and promoted fields it is written for."""
        made = {}

        def write(seen: State) -> tuple[tuple, dict]:
            made["base"] = f"{self.root}/base-{uuid.uuid4().hex[:8]}"
            rows, wanted = make(seen)
            made["cells"] = wanted.cells
            order = [_CELL, "id"] if wanted.cells else ["id"]
            rows = rows.select(*[f.name for f in self._fields(wanted)]).repartitionByRange(*order).sortWithinPartitions(*order)
            _with_id_filters(rows).parquet(made["base"])
            ranges = None if wanted.cells else self._write_ranges(made["base"])
            return (), {"old": (), "base": made["base"], "cells": wanted.cells, "promoted": wanted.promoted, "ranges": ranges}

        seen = self._replace(write)
        self.spark.sql(f"ALTER TABLE {self._quoted} SET LOCATION '{_escaped(made['base'])}'")
        self.spark.catalog.refreshTable(self._quoted)
        self._commits.forget_before(seen.number)
        for path in self._files(seen):
            if path != made["cells"]:
                workspace.remove(self.spark, path)

    def _write_ranges(self, base: str) -> str:
        """Write which ids each file of a base holds: file, first, last and n."""
        path = f"{base}/_ranges"  # out of the way of those who read the base, and deleted with it
        rows = self.spark.read.schema("id string").parquet(base).select("id", F.col("_metadata.file_name").alias("file"))
        rows.groupBy("file").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(path)
        return path

    # --- cells

    def _cells(self, state: State) -> cells.Cells:
        if not state.cells:
            raise RecordError(f"{self.name!r} has no cells: call index_cells first")
        if self._known_cells is None or self._known_cells[0] != state.cells:
            self._known_cells = (state.cells, cells.Cells.load(self.spark, state.cells, self.metric))
        return self._known_cells[1]

    def _in_cells(self, rows: DataFrame, state: State) -> DataFrame:
        placed = cells.assign(rows.drop(_CELL, _REACH), self._cells(state))
        return placed.withColumnsRenamed({cells.CELL: _CELL, cells.REACH: _REACH})

    def index_cells(self, n_cells: int | None = None, *, sample_rows: int = cells.SAMPLE_ROWS) -> None:
        """Learn cells from the records, and rewrite the base in their order; later records are put into them too."""
        fitted = cells.Cells.fit(self._current(), n_cells, metric=self.metric, sample_rows=sample_rows)
        path = f"{self.root}/cells-{uuid.uuid4().hex[:8]}"
        fitted.save(self.spark, path)
        self._known_cells = (path, fitted)

        def placed(state: State) -> tuple[DataFrame, State]:
            wanted = replace(state, cells=path)
            return self._in_cells(self._current(state), wanted), wanted

        self._rewrite(placed)

    def _shaped(self, batch: DataFrame) -> DataFrame:
        """A batch in the columns of the collection; undeclared fields are packed into the VARIANT payload."""
        declared = [c for c in batch.columns if c in self.schema.names]
        other = [c for c in batch.columns if c not in (*self.schema.names, "_order")]
        if other and "payload" in batch.columns:
            raise RecordError(f"undeclared fields beside a payload column: {', '.join(other)}")
        packed = [F.to_variant_object(F.struct(*other)).alias("payload")] if other else []
        order = [c for c in ("_order",) if c in batch.columns]
        return batch.select(*declared, *packed, *order)

    def upsert(self, batch: DataFrame, *, order_by: Sequence[Column] = (), strict: bool = True, **properties) -> DataFrame:
        """Insert or replace whole records by id; the newest by ``order_by`` wins within the batch.

        The batch is staged first. With ``strict``, one bad record keeps all of them out; otherwise the bad ones are
        left out. They are returned, with the reason.
        """
        order = list(order_by) or ([F.col(f"`{self.version}`")] if self.version in batch.columns else [])
        staged = self._staged(batch.withColumn("_order", F.struct(*order)) if order else batch)
        reason = quality.record_reason(dim=self.dim)
        return self._apply(staged, reason, strict, properties)

    def _staged(self, batch: DataFrame) -> DataFrame:
        """Write a batch to the shared folder and read it back, so that it is computed once."""
        path = workspace.new_path(self.spark, "batch")
        batch.write.parquet(path)
        return self.spark.read.schema(batch.schema).parquet(path)

    def _apply(self, staged: DataFrame, reason: Column, strict: bool, properties: Mapping) -> DataFrame:
        if staged.isEmpty():
            raise RecordError("the batch must not be empty")
        valid, rejects = quality.split_valid(staged, reason)
        if strict:
            quality.require_valid(rejects)
        batch = self._shaped(valid).withColumn("id", texts.trim(F.col("id").cast("string")))
        if "_order" in batch.columns:
            batch = records.latest(batch, [F.col("_order").desc()])
        else:
            twice = batch.groupBy("id").count().where("count > 1").select("id").limit(1).collect()
            if twice:
                raise RecordError(f"id {twice[0][0]!r} occurs more than once in the batch: give order_by")
        vector = vectors.as_double(F.col("vector"))
        self._commit(
            batch.withColumn("vector", vector).withColumn(_NORM, vectors.norm(vector)).withColumn("_deleted", F.lit(False)),
            **properties,
        )
        return rejects

    def store_texts(self, docs: DataFrame, provider: Provider, *, strict: bool = True, **columns) -> DataFrame:
        """Embed texts and upsert them; returns what was rejected."""
        staged = self._staged(store.store_texts(docs, provider, **self._ordered(docs, columns)))
        return self._apply_stored(staged, strict, {})

    def _ordered(self, docs: DataFrame, columns: dict) -> dict:
        """By default, the version decides within a batch too."""
        return {"order_by": [F.col(f"`{self.version}`")], **columns} if self.version in docs.columns else columns

    def _apply_stored(self, staged: DataFrame, strict: bool, properties: Mapping, rejects_to: str | None = None) -> DataFrame:
        reason = F.coalesce(quality.REASON, quality.record_reason(dim=self.dim))
        valid, rejects = quality.split_valid(staged.withColumn("_reason", reason).drop(quality.REASON), F.col("_reason"))
        if strict:
            quality.require_valid(rejects)
        if rejects_to:
            # before the commit: a batch that counts has its rejects written
            rejects.drop("_reason").write.mode("overwrite").parquet(rejects_to)
        if not valid.isEmpty():
            self._apply(valid.drop("_reason"), quality.record_reason(dim=self.dim), True, properties)
        elif properties:
            self._commit(self.spark.createDataFrame([], self.schema).withColumn("_deleted", F.lit(False)), **properties)
        return rejects.drop("_reason")

    def store_memories(
        self,
        docs: DataFrame,
        provider: Provider,
        *,
        strict: bool = True,
        properties: Mapping | None = None,
        rejects_to: str | None = None,
        **columns,
    ) -> tuple[DataFrame, DataFrame]:
        """Enrich, embed and upsert texts; returns the report of what was stored, and the rejects.

        The rejects are also written to the folder ``rejects_to``, if one is given.
        """
        # staged before the flags are added, which read it twice: each text is embedded once
        staged = self._staged(store.store_memories(docs, provider, **self._ordered(docs, columns)))
        # the flags tell of the records before the change; only what is reported of a text meets them, not the text
        accepted = store.store_report(staged.where(F.col(quality.REASON).isNull()))
        flagged = records.existing_flags(accepted, self._current())
        report = self._staged(flagged.select("id", "vector_dimensions", "was_update", "text_length", "payload_keys"))
        rejects = self._apply_stored(staged, strict, properties or {}, rejects_to)
        return report, rejects

    def delete(self, ids: records.Ids) -> DataFrame:
        """Delete by id and return ``id, found``; unknown ids do nothing."""
        if isinstance(ids, DataFrame):
            named = ids.select(texts.trim(F.col(ids.columns[0]).cast("string")).alias("id")).distinct()
        else:
            rows = [(v,) for v in arguments.record_ids(ids)]
            named = self.spark.createDataFrame(rows, "id string")
        flagged = self._staged(records.existing_flags(named, self._current(), "found"))
        self._commit(flagged.where("found").select("id", F.lit(True).alias("_deleted")))
        return flagged

    def delete_memory(self, id_: str) -> DataFrame:
        return self.delete([arguments.record_id(id_)])

    def delete_where(self, where: Mapping) -> None:
        """Delete the records that match a filter."""
        needed = records._needed(where)
        gone = F.lit(True).alias("_deleted")
        self._commit(lambda current: current.where(predicate(current, needed)).select("id", gone))

    def update_where(self, where: Mapping, values: Mapping[str, Any]) -> None:
        """Set payload fields on the records that match a filter; undeclared ones are set in the VARIANT payload."""
        if not values:
            raise RecordError("there is nothing to set")
        needed = records._needed(where)
        wrong = [c for c in values if c in ("id", "vector", "payload", *_HIDDEN) or not isinstance(c, str) or not c.strip()]
        if wrong:
            raise RecordError(f"not a payload field: {', '.join(map(str, wrong))}")
        declared = {k: v for k, v in values.items() if k in self.schema.names}
        other = {k: v for k, v in values.items() if k not in declared}

        def changed(current: DataFrame) -> DataFrame:
            rows = current.where(predicate(current, needed))
            types = {f.name: f.dataType for f in self.schema.fields}
            new = {k: F.lit(v).cast(types[k]) for k, v in declared.items()}
            if other:
                new["payload"] = _with_fields(F.col("payload"), other)
            return rows.withColumns({**new, "_deleted": F.lit(False)})

        self._commit(changed)

    # --- queries

    def get(self, ids: records.Ids, **options) -> DataFrame:
        return records.get_by_ids(self.read(), ids, **options)

    def scroll(self, *, limit: int | None = None, offset: str | None = None, where: Mapping | None = None, **options) -> DataFrame:
        """One page in id order, after the id ``offset``: of the base, the files from there on that the page needs."""
        state, size = self._state(), arguments.top_k(limit)
        if not state.ranges:
            rows = self._current(state)
            rows = rows if is_empty(where) else rows.where(predicate(rows, where))
            return records.scroll(self._shown(rows), limit=size, offset=offset, **options)
        ranges = self.spark.read.parquet(state.ranges)
        ranges = ranges if offset is None else ranges.where(F.col("last") > F.lit(offset))
        n_files = 1
        while True:
            # n_files rows reach the driver, and twice as many the next time
            files = ranges.orderBy("first").limit(n_files + 1).collect()
            whole = len(files) <= n_files
            files = files[:n_files]
            rows = self._current(state, [r["file"] for r in files])
            if not whole:
                rows = rows.where(F.col("id") <= F.lit(files[-1]["last"]))
            rows = rows if is_empty(where) else rows.where(predicate(rows, where))
            page = records.scroll(self._shown(rows), limit=size, offset=offset, **options)
            enough = sum(r["n"] for r in files) >= size
            if whole or enough and page.select("id").count() >= size:
                return page
            n_files *= 2

    def count(self, where: Mapping | None = None, *, exact: bool = True) -> int:
        """The number of records; an inexact count estimates it from a sketch of the ids."""
        return counts.count_records(self._current(), where, exact=exact).first()["count"]

    def count_memory(self, where: Mapping | None = None, *, exact: bool = False) -> DataFrame:
        """The count with checked arguments and the name of this collection."""
        return counts.count_memory(self._current(), where, exact=exact, collection=self.name)

    def _check_query(self, query: search.Query) -> None:
        if not isinstance(query, DataFrame):
            vectors.check_same_dim(self.dim, len(vectors.as_vector(query)))

    def _read_by(self, query: search.Query, effort: int | None) -> DataFrame:
        """All records, or those in the ``effort`` cells nearest to a query."""
        state = self._state()
        current = self._current(state)
        if effort is None:
            return current
        arguments.effort(effort)
        vector = query.first()[0] if isinstance(query, DataFrame) else query
        chosen = cells.near(self._cells(state), vector, effort)
        return current.where(cells.in_cells(chosen, F.col(_CELL)))

    def search(self, query: search.Query, top_k: int | None = None, *, effort: int | None = None, **options) -> DataFrame:
        """The nearest records; with ``effort``, only those in so many cells are looked at (see ``index_cells``)."""
        self._check_query(query)
        return self._searched(query, top_k, effort, options)

    def _searched(self, query: search.Query, top_k: int | None, effort: int | None, options: Mapping) -> DataFrame:
        rows = self._read_by(query, effort)
        where = options.get("where")
        # the filter may need columns that are not shown
        rows = rows.where(predicate(rows, where)) if where else rows
        options = {**options, "where": None}
        return search.search(self._shown(rows, _NORM), query, top_k, metric=self.metric, norm_col=_NORM, **options)

    def search_text(self, text: str, provider: Provider, top_k: int | None = None, *, effort: int | None = None, **options) -> DataFrame:
        query = provider.embed_one(self.spark, arguments.query_text(text))
        return self._searched(query, top_k, effort, options)

    def search_memory(self, query: str, provider: Provider, top_k: int | None = None, where=None) -> DataFrame:
        rows = self._current()
        checked = arguments.filter_dict(where)
        rows = rows.where(predicate(rows, checked)) if checked else rows
        found = search.search_memory(self._shown(rows, _NORM), query, provider, top_k, metric=self.metric, norm_col=_NORM)
        return found.withColumn("has_filter", F.lit(not is_empty(checked)))

    def search_batch(
        self,
        queries: DataFrame,
        top_k: int | None = None,
        *,
        effort: int | None = None,
        prune: bool = False,
        where: Mapping | None = None,
        payload: Sequence[str] = (),
        score_threshold: float | None = None,
        **options,
    ) -> DataFrame:
        """The nearest records to every query: of all records, or of those in the ``effort`` cells nearest to each.

        With ``prune``, the results are those of all records, but cells that can hold none of them are not read.
        """
        if effort is None and not prune:
            rows = self._current()
            rows = rows.where(predicate(rows, where)) if where else rows
            options |= {"payload": payload, "score_threshold": score_threshold}
            return search_batch(rows, queries, top_k, metric=self.metric, **options)
        if options or effort is not None and prune:
            raise RecordError(f"not together with cells: {', '.join(options) or 'effort and prune'}")
        state = self._state()
        index = self._current(state).withColumnsRenamed({_CELL: cells.CELL, _REACH: cells.REACH})
        chosen = index.where(predicate(index, where)) if where else index
        if prune:
            found = cells.search_exact(chosen, queries, self._cells(state), top_k, score_threshold=score_threshold)
        else:
            found = cells.search(chosen, queries, self._cells(state), top_k, effort=arguments.effort(effort), score_threshold=score_threshold)
        return found.join(index.select("id", *payload), "id").select(*found.columns, *payload) if payload else found

    def recommend(self, positive, negative=None, top_k: int | None = None, **options) -> DataFrame:
        return recommend.recommend(self.read(), positive, negative, top_k, metric=self.metric, **options)


def _with_id_filters(rows: DataFrame) -> DataFrameWriter:
    """A writer whose files can tell which ids they do not hold."""
    return rows.write.option("parquet.bloom.filter.enabled#id", "true")


def _with_fields(payload: Column, values: Mapping[str, Any]) -> Column:
    """A VARIANT object with fields set; one that is missing becomes an object of these fields."""
    rest = F.map_filter(payload.cast("map<string,variant>"), lambda k, _: ~k.isin(list(values)))
    new = F.create_map(*[c for k, v in values.items() for c in (F.lit(k), _as_variant(v))])
    return F.to_variant_object(F.map_concat(F.coalesce(rest, F.create_map().cast("map<string,variant>")), new))


def _as_variant(value: Any) -> Column:
    return F.parse_json(F.lit(json.dumps(value)))


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _escaped(value: Any) -> str:
    return str(value).replace("\\", "\\\\").replace("'", "\\'")
