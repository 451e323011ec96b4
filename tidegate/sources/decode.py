"""Message values -> rows and change events.

Every decoder keeps the rows it cannot decode: ``_error`` names the reason and is null on good rows, so that
``accepted`` and ``rejected`` split one parsed frame. ``_raw`` is the text of a rejected message.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.casts import cast_to_target
from ..functions.times import from_micros, local_to_utc
from ..functions.typemap import spark_type, split_target
from ..operators.changes import EVENT_COLUMNS
from .feed import UPSERT_KEY

RAW, ERROR = "_raw", "_error"
_CORRUPT = "_corrupt"


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(ERROR).isNull()).drop(ERROR, RAW)


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(ERROR).isNotNull())


# Wire units of numeric times, in units per second.
TIME_UNITS = {"millis": 1_000, "micros": 1_000_000, "nanos": 1_000_000_000}
_TIMES = ("TIMESTAMP", "TIMESTAMPTZ", "DATE")
_TEXTS = ("VARCHAR", "CHAR", "CHARACTER", "CHARACTER VARYING")


def _checked(target: str) -> bool:
    """Whether a column travels as text and is checked here; the JSON parser itself checks the others."""
    base, numbers = split_target(target)
    return base in (*_TIMES, "BYTEA", "BIT", "JSONB") or (base in _TEXTS and bool(numbers))


def _wire_schema(columns: Mapping[str, str], text: bool = False) -> T.StructType:
    """Schema of a row inside a message: times come as numbers or ISO text, binary and JSON columns as text."""
    return T.StructType(
        [T.StructField(c, T.StringType() if text or _checked(t) else spark_type(t)) for c, t in columns.items()]
    )


def _value(field: Column, target: str, zone: str, unit: str = "micros") -> Column:
    """A field of a message as its target type; null if it is text that does not fit.

    A numeric time counts ``unit`` since 1970, a numeric date days; the unit is declared, never guessed. Text is ISO.
    """
    base = split_target(target)[0]
    if base in _TIMES:
        number = F.when(field.rlike(r"^-?[0-9]+$"), field.try_cast("bigint"))
        if base == "DATE":
            return F.coalesce(F.date_add(F.lit("1970-01-01").cast("date"), number.cast("int")), field.try_cast("date"))
        per = TIME_UNITS[unit]
        micros = number
        if per < 1_000_000:
            micros = number * (1_000_000 // per)
        elif per > 1_000_000:  # whole numbers all the way: a double has too few digits for nanoseconds
            over = F.lit(per // 1_000_000)
            micros = F.call_function("div", number - F.pmod(number, over), over)
        if base == "TIMESTAMPTZ":
            return F.when(number.isNotNull(), F.timestamp_micros(micros)).otherwise(field.try_cast("timestamp"))
        wall = F.when(number.isNotNull(), from_micros(micros)).otherwise(field.try_cast("timestamp_ntz"))
        return wall if zone == "UTC" else local_to_utc(wall, zone)
    if _checked(target):
        return cast_to_target(field, target)
    return field


def _from_text(field: Column, target: str, zone: str = "UTC", unit: str = "micros") -> Column:
    """As ``_value``, of a field that is text whatever its type."""
    return _value(field, target, zone, unit) if _checked(target) else cast_to_target(field, target)


#: A unit for all columns, or one for each.
Unit = str | Mapping[str, str]


def _unit(unit: Unit, column: str) -> str:
    return unit if isinstance(unit, str) else unit.get(column, "micros")


def _failed(image: Column, columns: Mapping[str, str], unit: Unit = "micros", text: bool = False) -> Column:
    """Names of the columns of an image whose text does not fit their type."""
    value = _from_text if text else _value
    return F.array_compact(
        F.array(
            *[
                F.when(image[c].isNotNull() & value(image[c], t, "UTC", _unit(unit, c)).isNull(), F.lit(c))
                for c, t in columns.items()
                if text or _checked(t)
            ]
            or [F.lit(None).cast("string")]
        )
    )


def _failed_old(old: Column, columns: Mapping[str, str]) -> Column:
    """Names of the changed columns whose earlier text does not fit their type."""
    return F.array_compact(
        F.array(*[F.when(old[c].isNotNull() & _from_text(old[c], t).isNull(), F.lit(c)) for c, t in columns.items()])
    )


def _cast_error(*failed: Column) -> Column:
    """The reason of a row with failed columns, else null."""
    names = F.array_distinct(F.concat(*[F.coalesce(f, F.array().cast("array<string>")) for f in failed]))
    return F.when(F.size(names) > 0, F.concat(F.lit("cast failed: "), F.array_join(names, ",")))


def _row(image: Column, columns: Mapping[str, str], zone: str = "UTC", unit: Unit = "micros") -> Column:
    return F.when(
        image.isNotNull(), F.struct(*[_value(image[c], t, zone, _unit(unit, c)).alias(c) for c, t in columns.items()])
    )


def _text_row(image: Column, columns: Mapping[str, str]) -> Column:
    return F.when(image.isNotNull(), F.struct(*[_from_text(image[c], t).alias(c) for c, t in columns.items()]))


def _overlaid(old: Column, whole: Column, columns: Mapping[str, str], text: bool = False) -> Column:
    """The row before an update: ``old``, a map of the changed columns, over the row after it.

    A column counts as changed if ``old`` has its name, so one that was null before stays null.
    """
    value = _from_text if text else lambda f, t: _value(f, t, "UTC")
    return F.struct(
        *[
            F.when(F.map_contains_key(old, F.lit(c)), _from_text(old[c], t)).otherwise(value(whole[c], t)).alias(c)
            for c, t in columns.items()
        ]
    )


def _parse(value: Column, schema: T.StructType) -> Column:
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(value, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    # The parser stops after the first document; text with more of them is malformed.
    return F.when(F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))) == 1, parsed)


def _parsed(feed: DataFrame, *kept: Column | str, message: Column) -> DataFrame:
    """``kept`` columns and the parsed ``message`` as ``_m``.

    The one-element explode keeps filters on ``_m`` above the parsing. Without it the optimizer moves them below and
    repeats the parsing in every condition.
    """
    return feed.select(*kept, F.explode(F.array(message)).alias("_m"))


def _malformed(message: Column) -> Column:
    return message.isNull() | message[_CORRUPT].isNotNull()


def decode_json(
    feed: DataFrame, columns: Mapping[str, str], metadata: Sequence[Column] = (), unit: Unit = "micros"
) -> DataFrame:
    """PLAIN JSON: the declared columns, then ``metadata``, ``_raw`` and ``_error``; ``unit`` is that of numeric times."""
    text = F.col("value").cast("string")
    parsed = _parsed(feed, *metadata, text.alias(RAW), message=_parse(text, _wire_schema(columns)))
    kept = _kept(parsed)
    message = F.col("_m")
    error = F.when(_malformed(message), F.lit("malformed JSON")).otherwise(_cast_error(_failed(message, columns, unit)))
    return parsed.select(
        *[_value(message[c], t, "UTC", _unit(unit, c)).alias(c) for c, t in columns.items()],
        *kept,
        F.when(error.isNotNull(), F.col(RAW)).alias(RAW),
        error.alias(ERROR),
    )


def decode_csv(
    feed: DataFrame,
    columns: Mapping[str, str],
    delimiter: str = ",",
    without_header: bool = True,
    metadata: Sequence[Column] = (),
) -> DataFrame:
    """CSV lines: a row for each line of a message, where line breaks in quotes part none.

    With a header every message carries one as its first line, which is dropped.
    """
    text = F.col("value").cast("string")
    if not without_header:
        # a message that is only a header carries no row
        feed = feed.filter((F.instr(text, "\n") > 0) & (F.trim(F.substr(text, F.instr(text, "\n") + 1)) != "") | F.col("value").isNull())
        text = F.substr(text, F.instr(text, "\n") + 1)
    ddl = ", ".join(f"`{c}` string" for c in [*columns, _CORRUPT])
    options = {"sep": delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    lines = F.filter(F.split(text, r'\r?\n(?=(?:[^"]*"[^"]*")*[^"]*$)'), lambda line: line != "")
    several = F.when((F.instr(text, "\n") > 0) & (F.size(lines) > 0), lines).otherwise(F.array(text))
    split = feed.select(*metadata, F.explode(several).alias(RAW))
    names = [c for c in split.columns if c != RAW]
    parsed = _parsed(split, *names, RAW, message=F.from_csv(F.col(RAW), ddl, options))
    kept = _kept(parsed)
    message = F.col("_m")
    cast = parsed.select(
        *[cast_to_target(message[c], t).alias(c) for c, t in columns.items()], *kept, RAW, "_m"
    )
    failed = F.array_compact(
        F.array(*[F.when(message[c].isNotNull() & F.col(c).isNull(), F.lit(c)) for c in columns])
    )
    error = (
        F.when(message.isNull() | message[_CORRUPT].isNotNull(), F.lit("malformed CSV"))
        .when(F.size(failed) > 0, F.concat(F.lit("cast failed: "), F.array_join(failed, ",")))
    )
    return cast.select(*columns, *kept, F.when(error.isNotNull(), F.col(RAW)).alias(RAW), error.alias(ERROR))


def decode_bytes(feed: DataFrame, column: str = "id", metadata: Sequence[Column] = ()) -> DataFrame:
    """The value as one binary column; nothing can be malformed."""
    return feed.select(F.col("value").cast("binary").alias(column), *metadata)


def decode_key(columns: Mapping[str, str] | None, encode: str = "JSON") -> Column:
    """The key as a struct of ``columns`` (JSON) or as it is (BYTES)."""
    if encode.upper() == "BYTES":
        return F.col("key").cast("binary")
    if encode.upper() != "JSON" or not columns:
        raise ValueError("a key is decoded as JSON with declared columns, or kept as BYTES")
    return _row(F.from_json(F.col("key").cast("string"), _wire_schema(columns)), columns)


def _kept(parsed: DataFrame) -> list[str]:
    """Columns that are not part of the parsing: the metadata."""
    return [c for c in parsed.columns if c not in ("_m", RAW, "_offset", "_pos", "_row", "_k", UPSERT_KEY)]


def _events(
    decoded: DataFrame, op: Column, error: Column, has_before: Column, has_after: Column, **columns: Column
) -> DataFrame:
    """Change events from parsed messages, then their metadata columns.

    Reasons to reject are told from message fields only, so that the filter on them, which runs before the projection,
    does not build the row images.
    """
    reason = F.coalesce(
        error,
        F.when(op.isNull(), F.lit("unknown operation"))
        .when(op.isin("r", "c", "u") & ~has_after, F.lit("no after image"))
        .when((op == "d") & ~has_before, F.lit("no before image")),
    )
    columns["op"] = op
    return decoded.select(
        *[columns[c].alias(c) for c in EVENT_COLUMNS],
        *_kept(decoded),
        F.when(reason.isNotNull(), F.col(RAW)).alias(RAW),
        reason.alias(ERROR),
    )


def decode_debezium(
    feed: DataFrame,
    columns: Mapping[str, str],
    order_ddl: str = "lsn bigint, txId bigint",
    time_zone: str = "UTC",
    metadata: Sequence[Column] = (),
    unit: Unit = "micros",
) -> DataFrame:
    """``{op, before, after, source, ts_us or ts_ms}``, alone or as the ``payload`` beside a ``schema`` -> change events.

    ``unit`` is that of numeric times in rows. ``order_ddl`` names the log position inside ``source``. Messages without a value are the tombstones that follow a
    delete for topic compaction and carry no change of their own.
    """
    row = _wire_schema(columns)
    order = T.StructType.fromDDL(order_ddl)
    source = T.StructType.fromDDL("db string, schema string, table string, collection string, ts_us bigint, ts_ms bigint, txId bigint")
    names = set(source.fieldNames())
    source = T.StructType(source.fields + [f for f in order.fields if f.name not in names])
    schema = (
        T.StructType().add("op", "string").add("before", row).add("after", row).add("source", source).add("ts_us", "long")
    )
    text = F.col("value").cast("string")
    outer = T.StructType([*schema.fields, T.StructField("payload", schema)])
    parsed = _parsed(feed.filter("value IS NOT NULL"), *metadata, text.alias(RAW), message=_parse(text, outer))
    part = lambda f: F.coalesce(F.col("_m")["payload"][f], F.col("_m")[f])
    names = schema.fieldNames()
    parsed = parsed.withColumn(
        "_m", F.when(F.col("_m").isNotNull(), F.struct(*[part(f).alias(f) for f in names], F.col("_m")[_CORRUPT].alias(_CORRUPT)))
    )
    m = F.col("_m")
    src = m["source"]
    return _events(
        parsed,
        op=F.when(m["op"].isin("r", "c", "u", "d"), m["op"]),
        error=F.when(_malformed(m), F.lit("malformed JSON")).otherwise(
            _cast_error(_failed(m["before"], columns, unit), _failed(m["after"], columns, unit))
        ),
        has_before=m["before"].isNotNull(),
        has_after=m["after"].isNotNull(),
        before=_row(m["before"], columns, time_zone, unit),
        after=_row(m["after"], columns, time_zone, unit),
        order_key=F.struct(*[src[f.name].alias(f.name) for f in order]),
        commit_ts=F.timestamp_micros(F.coalesce(src["ts_us"], src["ts_ms"] * 1000)),
        db=src["db"],
        schema=src["schema"],
        table=F.coalesce(src["table"], src["collection"]),
        txid=src["txId"],
    )


# Maxwell and Canal operation names. Maxwell's bootstrap start and end markers carry no row.
MAXWELL_OPS = {"insert": "c", "update": "u", "delete": "d", "bootstrap-insert": "r"}
MAXWELL_MARKERS = ("bootstrap-start", "bootstrap-complete")
CANAL_OPS = {"INSERT": "c", "UPDATE": "u", "DELETE": "d"}


def _op(name: Column, ops: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in ops.items() for x in pair])[name]


def decode_maxwell(feed: DataFrame, columns: Mapping[str, str], metadata: Sequence[Column] = ()) -> DataFrame:
    """``{database, table, type, ts, xid, data, old}`` -> change events, ordered by message offset.

    ``old`` holds only the changed columns, so the before image is ``data`` overlaid with it.
    """
    row = _wire_schema(columns)
    schema = (
        T.StructType()
        .add("database", "string")
        .add("table", "string")
        .add("type", "string")
        .add("ts", "long")
        .add("xid", "long")
        .add("data", row)
        .add("old", T.MapType(T.StringType(), T.StringType()))
    )
    text = F.col("value").cast("string")
    offset = F.col("offset").alias("_offset")
    parsed = _parsed(
        feed.filter("value IS NOT NULL"), *metadata, offset, text.alias(RAW), message=_parse(text, schema)
    )
    m = F.col("_m")
    parsed = parsed.filter(F.coalesce(~m["type"].isin(*MAXWELL_MARKERS), F.lit(True)))
    op = _op(m["type"], MAXWELL_OPS)
    overlaid = _overlaid(m["old"], m["data"], columns)
    has_row = m["data"].isNotNull()
    return _events(
        parsed,
        op=op,
        error=F.when(_malformed(m), F.lit("malformed JSON")).otherwise(
            _cast_error(_failed(m["data"], columns), _failed_old(m["old"], columns))
        ),
        has_before=has_row,
        has_after=has_row,
        before=F.when(has_row & op.isin("u", "d"), overlaid),
        after=F.when(op != "d", _row(m["data"], columns)),
        order_key=F.struct(F.col("_offset").alias("offset")),
        commit_ts=F.timestamp_seconds(m["ts"]),
        db=m["database"],
        schema=F.lit(None).cast("string"),
        table=m["table"],
        txid=m["xid"],
    )


def decode_canal(feed: DataFrame, columns: Mapping[str, str], metadata: Sequence[Column] = ()) -> DataFrame:
    """``{data: [..], old: [..], database, table, type, es, isDdl}`` -> change events, ordered by offset and position.

    Values are text and cast to the declared types; a value that does not fit rejects the row. DDL messages are
    skipped.
    """
    row = _wire_schema(columns, text=True)
    schema = (
        T.StructType()
        .add("data", T.ArrayType(row))
        .add("old", T.ArrayType(T.MapType(T.StringType(), T.StringType())))
        .add("database", "string")
        .add("table", "string")
        .add("type", "string")
        .add("es", "long")
        .add("isDdl", "boolean")
    )
    text = F.col("value").cast("string")
    offset = F.col("offset").alias("_offset")
    parsed = _parsed(
        feed.filter("value IS NOT NULL"), *metadata, offset, text.alias(RAW), message=_parse(text, schema)
    )
    parsed = parsed.filter(~F.coalesce(F.col("_m")["isDdl"], F.lit(False)))
    rows = parsed.select("*", F.posexplode_outer(F.col("_m")["data"]).alias("_pos", "_row"))
    m, text = F.col("_m"), F.col("_row")
    op = _op(m["type"], CANAL_OPS)
    changed = F.get(m["old"], F.col("_pos"))
    overlaid = _overlaid(changed, text, columns, text=True)
    error = F.when(_malformed(m), F.lit("malformed JSON")).otherwise(
        _cast_error(_failed(text, columns, text=True), _failed_old(changed, columns))
    )
    has_row = text.isNotNull()
    return _events(
        rows,
        op=op,
        error=error,
        has_before=has_row,
        has_after=has_row,
        before=F.when(has_row & op.isin("u", "d"), overlaid),
        after=F.when(op != "d", _text_row(text, columns)),
        order_key=F.struct(F.col("_offset").alias("offset"), F.col("_pos").alias("position")),
        commit_ts=F.timestamp_millis(m["es"]),
        db=m["database"],
        schema=F.lit(None).cast("string"),
        table=m["table"],
        txid=F.lit(None).cast("long"),
    )


def decode_upsert(
    feed: DataFrame,
    columns: Mapping[str, str],
    key_columns: Mapping[str, str] | None = None,
    metadata: Sequence[Column] = (),
    unit: Unit = "micros",
) -> DataFrame:
    """Keyed JSON messages -> flat change rows: ``_op, rw_key, _offset`` and the columns; a null value is a delete.

    With ``key_columns`` the JSON key gives the primary key columns too, so that deletes have them.
    """
    value = F.col("value").cast("string")
    parsed = _parsed(
        feed,
        *metadata,
        F.col("key").cast("string").alias(UPSERT_KEY),
        F.col("offset").alias("_offset"),
        value.alias(RAW),
        *([decode_key(key_columns).alias("_k")] if key_columns else []),
        message=_parse(value, _wire_schema(columns)),
    )
    m, delete = F.col("_m"), F.col(RAW).isNull()
    keys = key_columns or {}

    def column(c: str, t: str) -> Column:
        decoded = _value(m[c], t, "UTC", _unit(unit, c))
        return F.coalesce(decoded, F.col("_k")[c]) if c in keys else decoded

    null_key = reduce(lambda a, b: a | b, [column(c, columns[c]).isNull() for c in keys if c in columns], F.lit(False))
    error = F.coalesce(
        F.when(F.col(UPSERT_KEY).isNull(), F.lit("no key"))
        .when(~delete & _malformed(m), F.lit("malformed JSON"))
        .when(null_key, F.lit("unreadable key")),
        F.when(~delete, _cast_error(_failed(m, columns, unit))),
    )
    return parsed.select(
        F.when(delete, F.lit("d")).otherwise(F.lit("u")).alias("_op"),
        UPSERT_KEY,
        "_offset",
        *[column(c, t).alias(c) for c, t in columns.items()],
        *_kept(parsed),
        F.when(error.isNotNull(), F.col(RAW)).alias(RAW),
        error.alias(ERROR),
    )


def documents(events: DataFrame) -> DataFrame:
    """Change events of a document collection as flat rows ``_op, _order, _id, payload``; a delete has only ``_id``."""
    delete = F.col("op") == "d"
    return events.select(
        F.col("op").alias("_op"),
        F.col("order_key").alias("_order"),
        F.when(delete, F.col("before")["_id"]).otherwise(F.col("after")["_id"]).alias("_id"),
        F.when(~delete, F.col("after")["payload"]).alias("payload"),
    )


def decode_documents(feed: DataFrame, order_ddl: str = "ts_us bigint, ord bigint", metadata: Sequence[Column] = ()) -> DataFrame:
    """Envelopes of a document collection -> ``op, _id, payload, changed, removed, cut`` and the columns about each event.

    ``after`` is a document, as JSON or as JSON text, or missing where ``updateDescription`` says what changed: ``changed`` maps
    dotted paths to JSON, ``removed`` lists paths, ``cut`` arrays and their new sizes. The id is that of the message key, else
    the document's own.
    """
    order = T.StructType.fromDDL(order_ddl)
    source = T.StructType.fromDDL("db string, collection string, ts_us bigint, ts_ms bigint")
    source = T.StructType(source.fields + [f for f in order.fields if f.name not in source.fieldNames()])
    patch = T.StructType.fromDDL("updatedFields string, removedFields array<string>, truncatedArrays array<struct<field: string, size: int>>")
    schema = T.StructType().add("op", "string").add("before", "string").add("after", "string").add("updateDescription", patch).add("source", source)
    text, key = F.col("value").cast("string"), F.col("key").cast("string")
    outer = T.StructType([*schema.fields, T.StructField("payload", schema)])
    parsed = _parsed(feed.filter("value IS NOT NULL"), *metadata, key.alias("_k"), text.alias(RAW), message=_parse(text, outer))
    kept = _kept(parsed)
    m = F.col("_m")
    part = lambda f: F.coalesce(m["payload"][f], m[f])
    # The key's id is JSON text: a text id is quoted once more.
    plain = lambda j: F.get_json_object(F.concat(F.lit('{"v":'), j, F.lit("}")), "$.v")
    in_key = F.coalesce(F.get_json_object("_k", "$.id"), F.get_json_object("_k", "$.payload.id"))
    # a plain number is the same text either way
    unquoted = F.transform(F.array(in_key), lambda j: F.when(j.rlike("^(0|[1-9][0-9]{0,17})$"), j).otherwise(F.coalesce(plain(j), j)))[0]
    own = F.coalesce(F.get_json_object(part("after"), "$._id"), F.get_json_object(part("before"), "$._id"))
    changed = F.call_function("try_parse_json", part("updateDescription")["updatedFields"]).try_cast("map<string,variant>")
    read = parsed.select(
        *kept,
        RAW,
        _malformed(m).alias("_bad"),
        F.when(part("op").isin("r", "c", "u", "d"), part("op")).alias("op"),
        F.coalesce(unquoted, own).alias("_id"),
        F.when(part("op") != "d", part("after")).alias("payload"),
        F.transform_values(changed, lambda _, v: F.to_json(v)).alias("changed"),
        part("updateDescription")["removedFields"].alias("removed"),
        part("updateDescription")["truncatedArrays"].alias("cut"),
        (part("updateDescription")["updatedFields"].isNotNull() & changed.isNull()).alias("_bad_patch"),
        F.struct(*[part("source")[f.name].alias(f.name) for f in order]).alias("order_key"),
        F.timestamp_micros(F.coalesce(part("source")["ts_us"], part("source")["ts_ms"] * 1000)).alias("commit_ts"),
        part("source")["db"].alias("db"),
        part("source")["collection"].alias("table"),
    )
    # exploded so that the conditions on the fields, and the filter on the error, share one reading of them
    names = read.columns
    read = read.select(F.explode(F.array(F.struct(*names))).alias("_r")).select("_r.*")
    nothing = F.col("payload").isNull() & F.col("changed").isNull() & F.col("removed").isNull() & F.col("cut").isNull()
    error = (
        F.when(F.col("_bad"), "malformed JSON")
        .when(F.col("op").isNull(), "unknown operation")
        .when(F.col("_id").isNull(), "no document id")
        .when(F.col("_bad_patch") | (F.col("payload").isNotNull() & F.json_object_keys("payload").isNull()), "malformed document")
        .when((F.col("op") != "d") & nothing, "no after image")
    )
    return read.select(
        "op", "_id", "payload", "changed", "removed", "cut", "order_key", "commit_ts", "db", "table", *kept,
        F.when(error.isNotNull(), F.col(RAW)).alias(RAW),
        error.alias(ERROR),
    )
