from .casts import cast_to_target, split_rejects, typed_projection
from .times import from_micros, local_to_utc, to_micros
from .typemap import map_type, mysql_type, postgres_type, spark_type, sqlserver_type, struct_of

__all__ = [
    "cast_to_target",
    "from_micros",
    "local_to_utc",
    "map_type",
    "mysql_type",
    "postgres_type",
    "spark_type",
    "split_rejects",
    "sqlserver_type",
    "struct_of",
    "to_micros",
    "typed_projection",
]
