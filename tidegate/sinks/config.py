"""Where rows go. Credentials and connector settings travel in ``options`` unchanged."""

from __future__ import annotations

from dataclasses import dataclass, field


def _one_of(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}; got {value!r}")


def _present(name: str, value: str | None) -> None:
    if not value:
        raise ValueError(f"{name} is required")


def _key_list(text: str | None) -> list[str]:
    return [c.strip() for c in (text or "").split(",") if c.strip()]


@dataclass(frozen=True)
class FileSink:
    """Object-store files, append only."""

    path: str
    data_type: str = "append-only"
    format: str = "PLAIN"
    encode: str = "PARQUET"
    force_append_only: bool = True
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        _present("path", self.path)
        # Accepted option values.
        _one_of("data_type", self.data_type, ("append-only",))
        _one_of("format", self.format, ("PLAIN", "UPSERT", "DEBEZIUM"))
        _one_of("encode", self.encode, ("PARQUET", "JSON", "CSV"))


@dataclass(frozen=True)
class JdbcSink:
    """A database table; upserts need its primary key."""

    url: str
    table: str
    schema: str = "public"
    data_type: str = "append-only"
    primary_key: str | None = None
    tombstone: str | None = None  # column of the table that marks deleted keys
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        _present("url", self.url)
        _present("table", self.table)
        _one_of("data_type", self.data_type, ("append-only", "upsert"))
        if self.data_type == "upsert" and not self.keys:
            raise ValueError("primary_key is required for upsert sinks")

    @property
    def keys(self) -> list[str]:
        return _key_list(self.primary_key)

    @property
    def target(self) -> str:
        return f"{self.schema}.{self.table}"


@dataclass(frozen=True)
class LakeSink:
    """A lake table below a warehouse path or in a catalog."""

    warehouse: str
    database: str
    table: str
    catalog_type: str = "storage"
    catalog_name: str | None = None
    catalog_uri: str | None = None
    data_type: str = "append-only"
    primary_key: str | None = None
    force_append_only: bool = False
    create_table: bool = True
    tombstone: str | None = None  # column of a catalog table that marks deleted keys
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for name in ("warehouse", "database", "table"):
            _present(name, getattr(self, name))
        _one_of("data_type", self.data_type, ("append-only", "upsert"))
        _one_of("catalog_type", self.catalog_type, ("storage", "glue", "rest", "jdbc"))
        if self.data_type == "upsert" and not self.keys:
            raise ValueError("primary_key is required for upsert sinks")
        if self.catalog_type == "glue":
            _present("catalog_name for a glue catalog", self.catalog_name)
        if self.catalog_type in ("rest", "jdbc"):
            _present(f"catalog_uri for a {self.catalog_type} catalog", self.catalog_uri)

    @property
    def keys(self) -> list[str]:
        return _key_list(self.primary_key)

    @property
    def path(self) -> str:
        return f"{self.warehouse.rstrip('/')}/{self.database}/{self.table}"

    @property
    def identifier(self) -> str:
        parts = [self.catalog_name, self.database, self.table]
        return ".".join(f"`{p}`" for p in parts if p)


@dataclass(frozen=True)
class SearchSink:
    """A search index filled with bulk requests; the index is fixed or taken from a column."""

    url: str
    index: str | None = None
    index_column: str | None = None
    primary_key: str | None = None
    delimiter: str = ","
    routing_column: str | None = None
    batch_num_messages: int | None = None
    batch_size_kb: int | None = None
    concurrent_requests: int | None = None
    auto_schema_change: bool = False

    def __post_init__(self) -> None:
        if not self.url.startswith(("http://", "https://")):
            raise ValueError("url must start with http:// or https://")
        if bool(self.index) == bool(self.index_column):
            raise ValueError("give either index or index_column")
        for name in ("batch_num_messages", "batch_size_kb", "concurrent_requests"):
            value = getattr(self, name)
            if value is not None and value <= 0:
                raise ValueError(f"{name} must be positive")

    @property
    def keys(self) -> list[str]:
        return _key_list(self.primary_key)

    @classmethod
    def high_throughput(cls, url: str, index: str, **kwargs) -> SearchSink:
        # Messages per request, KB per request, requests at a time.
        return cls(
            url, index, **{"batch_num_messages": 1000, "batch_size_kb": 5000, "concurrent_requests": 5, **kwargs}
        )
