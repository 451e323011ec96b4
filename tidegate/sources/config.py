"""What a source reads and how its messages are laid out.

Only settings that change rows are fields here. Everything else (security, fetch sizes, registry credentials) goes
through ``options`` to the Spark reader unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Accepted option values.
FORMATS = ("PLAIN", "UPSERT", "DEBEZIUM", "MAXWELL", "CANAL")
ENCODINGS = ("JSON", "AVRO", "PROTOBUF", "BYTES", "CSV", "PARQUET")
START_MODES = ("earliest", "latest", "timestamp")
UPSERT_ENCODINGS = ("JSON", "AVRO", "PROTOBUF")
CDC_FORMATS = ("DEBEZIUM", "MAXWELL", "CANAL")


def _one_of(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}; got {value!r}")


def _present(name: str, value: str | None) -> None:
    if not value or not value.strip():
        raise ValueError(f"{name} is required")


@dataclass(frozen=True)
class KafkaSource:
    """A topic: start position, format, encoding."""

    bootstrap_servers: str
    topic: str
    format: str = "PLAIN"
    encode: str = "JSON"
    key_encode: str | None = None
    start: str = "earliest"
    start_millis: int | None = None
    csv_delimiter: str = ","
    csv_without_header: bool = True
    options: dict[str, str] = field(default_factory=dict)
    time_unit: str = "micros"  # of numeric times in messages: millis, micros or nanos
    time_units: dict[str, str] = field(default_factory=dict)  # of columns with a unit of their own
    time_zone: str = "UTC"  # of wall-clock times in DEBEZIUM messages

    def __post_init__(self) -> None:
        for unit in (self.time_unit, *self.time_units.values()):
            _one_of("time_unit", unit, ("millis", "micros", "nanos"))
        object.__setattr__(self, "format", self.format.upper())
        object.__setattr__(self, "encode", self.encode.upper())
        _present("bootstrap_servers", self.bootstrap_servers)
        _present("topic", self.topic)
        _one_of("format", self.format, FORMATS)
        _one_of("encode", self.encode, ENCODINGS)
        _one_of("start", self.start, START_MODES)
        if self.start == "timestamp" and self.start_millis is None:
            raise ValueError("start_millis is required to start from a timestamp")
        if self.format == "UPSERT":
            _one_of("encode of UPSERT messages", self.encode, UPSERT_ENCODINGS)
        if self.format in CDC_FORMATS:
            _one_of(f"encode of {self.format} messages", self.encode, ("JSON",))

    @property
    def table_name(self) -> str:
        return self.topic.replace(".", "_").replace("-", "_")

    def reader_options(self) -> dict[str, str]:
        """Options of Spark's Kafka source."""
        options = {"kafka.bootstrap.servers": self.bootstrap_servers, "subscribe": self.topic}
        if self.start == "timestamp":
            options["startingTimestamp"] = str(self.start_millis)
        else:
            options["startingOffsets"] = self.start
        return {**options, **self.options}


@dataclass(frozen=True)
class DatabaseSource:
    """A captured database: ``order`` names the log position, greatest last, in the envelope's ``source`` block."""

    database: str
    tables: str = "*"
    schema: str = "public"
    snapshot: bool = True
    snapshot_interval: int = 1
    snapshot_batch_size: int = 1000
    rows_per_split: int | None = None
    parallelism: int | None = None
    even_splits: bool = True
    transactional: bool = False
    auto_schema_change: bool = False
    options: dict[str, str] = field(default_factory=dict)
    time_unit: str = "micros"  # of numeric times in rows: millis, micros or nanos
    time_units: dict[str, str] = field(default_factory=dict)  # of columns with a unit of their own

    dialect = "postgres"
    order = ("lsn", "txId")
    order_ddl = "lsn bigint, txId bigint"

    def __post_init__(self) -> None:
        _present("database", self.database)
        _present("tables", self.tables)
        for unit in (self.time_unit, *self.time_units.values()):
            if unit not in ("millis", "micros", "nanos"):
                raise ValueError("time_unit must be millis, micros or nanos")
        for name in ("snapshot_interval", "snapshot_batch_size", "rows_per_split", "parallelism"):
            value = getattr(self, name)
            if value is not None and value <= 0:
                raise ValueError(f"{name} must be positive")

    @property
    def patterns(self) -> list[str]:
        return [p.strip() for p in self.tables.split(",")]

    @property
    def schemas(self) -> list[str]:
        """Schemas the patterns name, each once, in order."""
        return list(dict.fromkeys(p.split(".")[0] if "." in p else self.schema for p in self.patterns))


@dataclass(frozen=True)
class PostgresSource(DatabaseSource):
    """Ordered by write-ahead log position."""


@dataclass(frozen=True)
class MySqlSource(DatabaseSource):
    """Ordered by binlog file and position; DATETIME values are wall-clock times of ``server_time_zone``."""

    server_time_zone: str = "UTC"

    dialect = "mysql"
    order = ("file", "pos")
    order_ddl = "file string, pos bigint"


@dataclass(frozen=True)
class SqlServerSource(DatabaseSource):
    """Ordered by commit and change sequence numbers, which are fixed-width text."""

    schema: str = "dbo"

    dialect = "sqlserver"
    order = ("commit_lsn", "change_lsn")
    order_ddl = "commit_lsn string, change_lsn string"


@dataclass(frozen=True)
class MongoSource(DatabaseSource):
    """Documents as ``_id, payload``; ordered by event time and the ordinal within it."""

    dialect = "mongo"
    order = ("ts_us", "ord")
    order_ddl = "ts_us bigint, ord bigint"
