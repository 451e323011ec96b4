"""Documents kept as their paths.

A change of a document sets, removes or cuts values at dotted paths; the whole document is the value at the empty path. The
last change at each path is all that matters, so a collection is a table keyed by document and path that takes changes in any
order, a hot document's as well: tasks keep one row per path of their own. A document is put together when it is read, by
its path changes in order; there are as many as it has paths that were ever changed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

SET, REMOVE, CUT = "set", "remove", "cut"


def path_changes(events: DataFrame, *kept: str) -> DataFrame:
    """``_op, _order, _id, path, kind, value, size`` of document events ``op, _id, payload, changed, removed, cut, order_key``.

    ``kept`` are more columns of the events to carry along.

    An event with its whole document, or a delete, is one change at the empty path. A cut of an array to a size has the size
    in its path, for a later cut to another size doesn't undo it.
    """
    whole = F.array(
        F.struct(
            F.lit("").alias("path"),
            F.when(F.col("op") == "d", REMOVE).otherwise(SET).alias("kind"),
            F.when(F.col("op") != "d", F.col("payload")).alias("value"),
            F.lit(None).cast("int").alias("size"),
        )
    )
    none = F.lit(None).cast("int")
    sets = F.transform(
        F.map_entries("changed"), lambda e: F.struct(e["key"].alias("path"), F.lit(SET).alias("kind"), e["value"].alias("value"), none.alias("size"))
    )
    removes = F.transform(
        "removed", lambda p: F.struct(p.alias("path"), F.lit(REMOVE).alias("kind"), F.lit(None).cast("string").alias("value"), none.alias("size"))
    )
    cuts = F.transform(
        "cut",
        lambda c: F.struct(
            F.concat(c["field"], F.lit("#"), c["size"].cast("string")).alias("path"),
            F.lit(CUT).alias("kind"),
            F.lit(None).cast("string").alias("value"),
            c["size"].alias("size"),
        ),
    )
    empty = F.array().cast("array<struct<path:string,kind:string,value:string,size:int>>")
    parts = F.concat(*[F.coalesce(p, empty) for p in (sets, removes, cuts)])
    of = events.withColumn("_c", F.explode(F.when((F.col("op") == "d") | F.col("payload").isNotNull(), whole).otherwise(parts)))
    return of.select(F.lit("u").alias("_op"), F.col("order_key").alias("_order"), "_id", "_c.*", *kept)


def _place(doc: object, steps: list[str], make: bool) -> tuple[object, object] | None:
    """The container that the last step names a value in, and its key; with ``make`` missing objects are made."""
    for step, after in zip(steps, [*steps[1:], None]):
        key: object = step
        if isinstance(doc, list):
            if not step.isdigit():
                return None
            key = int(step)
            while make and len(doc) <= key:
                doc.append(None)
            if key >= len(doc):
                return None
        elif not isinstance(doc, dict):
            return None
        if after is None:
            return doc, key
        inner = doc[key] if isinstance(doc, list) else doc.get(step)
        if not isinstance(inner, (dict, list)):
            if not make:
                return None
            inner = doc[key] = {}
        doc = inner
    return None


def patched(changes: list[dict]) -> str | None:
    """JSON text of the document that path changes make, in order; None if it is removed."""
    text = whole = None
    doc: object = None
    there = False
    for c in changes:
        path = c["path"].rsplit("#", 1)[0] if c["kind"] == CUT else c["path"]
        if not path:
            there, whole = c["kind"] == SET, c["value"]
            doc, text = (json.loads(whole), whole) if there else (None, None)
            continue
        if not there:  # a patch whose document hasn't come
            doc, there = {}, True
        text = None
        found = _place(doc, path.split("."), c["kind"] == SET)
        if not found:
            continue
        at, key = found
        if c["kind"] == SET:
            at[key] = json.loads(c["value"])
        elif c["kind"] == REMOVE:
            if isinstance(at, list):
                at[key] = None
            else:
                at.pop(key, None)
        else:
            value = at[key] if isinstance(at, list) else at.get(key)
            if isinstance(value, list):
                del value[c["size"] :]
    if not there:
        return None
    return text if text is not None else json.dumps(doc, separators=(",", ":"), ensure_ascii=False)


def assembled(rows: DataFrame) -> DataFrame:
    """``_id, payload`` of the documents that path changes ``_id, path, kind, value, size, _order`` make.

    What comes before a document's last whole change is cut off, and only documents patched since are parsed.
    """
    part = F.struct("_order", "path", "kind", "value", "size")
    grouped = rows.groupBy("_id").agg(F.array_sort(F.collect_list(part)).alias("changes"))
    # A cut of the empty path counts as whole, as in patched.
    wholes = F.transform("changes", lambda c: (c["path"] == "") | ((c["kind"] == CUT) & c["path"].rlike("^#[^#]*$")))
    since = F.size("changes") - F.array_position(F.reverse(wholes), F.lit(True)).cast("int")  # the last whole change, from 0
    last = F.when(F.exists(wholes, lambda w: w), since).otherwise(-1)
    cut = grouped.select("_id", "changes", F.explode(F.array(last)).alias("last"))
    whole = F.get("changes", F.col("last"))
    field = lambda name: F.transform(F.slice("changes", F.col("last") + 2, F.size("changes")), lambda c: c[name]).alias(name)
    kept = cut.select(
        "_id", F.when(whole["kind"] == SET, whole["value"]).alias("whole"), *[field(c) for c in ("path", "kind", "value", "size")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("whole")
            later = pc.greater(pc.list_value_length(b.column("path")), 0)
            if pc.any(later).as_py():
                some = b.filter(later)
                lists = zip(*[some.column(c).to_pylist() for c in ("whole", "path", "kind", "value", "size")])
                made = [_patched_since(whole, *changes) for whole, *changes in lists]
                texts = pc.replace_with_mask(texts, later, pa.array(made, pa.string()).cast(texts.type))
            made = pa.RecordBatch.from_arrays([b.column("_id"), texts.cast(pa.string())], names=["_id", "payload"])
            yield made.filter(made.column("payload").is_valid())

    return kept.mapInArrow(run, "_id string, payload string")


def _patched_since(whole: str | None, *fields: list) -> str | None:
    first = [] if whole is None else [{"path": "", "kind": SET, "value": whole, "size": None}]
    return patched(first + [dict(zip(("path", "kind", "value", "size"), c)) for c in zip(*fields)])
