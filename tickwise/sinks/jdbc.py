"""Keyed upsert into a JDBC table: staging table, then one merge statement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tickwise.schemas import OUTPUT_KEYS


def merge_statement(table: str, staging_table: str, cols: Sequence[str], keys: Sequence[str],
                    dialect: str = "postgres") -> str:
    """The one set-based statement that merges ``staging_table`` into
    ``table`` on ``keys``, last write wins: PostgreSQL ``INSERT ... ON
    CONFLICT ... DO UPDATE``, or SQL:2003 ``MERGE`` for other databases."""
    col_list = ", ".join(f'"{c}"' for c in cols)
    key_list = ", ".join(f'"{k}"' for k in keys)
    non_keys = [c for c in cols if c not in keys]
    if dialect == "postgres":
        sets = ", ".join(f'"{c}" = EXCLUDED."{c}"' for c in non_keys)
        return (
            f"INSERT INTO {table} ({col_list}) SELECT {col_list} FROM {staging_table} "
            f"ON CONFLICT ({key_list}) DO UPDATE SET {sets}"
        )
    on = " AND ".join(f't."{k}" = s."{k}"' for k in keys)
    sets = ", ".join(f'"{c}" = s."{c}"' for c in non_keys)
    vals = ", ".join(f's."{c}"' for c in cols)
    return (
        f"MERGE INTO {table} t USING {staging_table} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT ({col_list}) VALUES ({vals})"
    )


def upsert_jdbc(
    updates: DataFrame,
    *,
    url: str,
    table: str,
    keys: Sequence[str] = OUTPUT_KEYS,
    staging_table: str,
    properties: dict | None = None,
    dialect: str = "postgres",
) -> None:
    """Upsert into a JDBC table: write a staging table with the JDBC writer
    (parallel, batched inserts from the executors), then one set-based
    statement on the driver merges staging into the target and drops the
    staging table in the same transaction. ``staging_table`` should carry
    the writer and batch id so concurrent writers do not collide.

    The statement itself is unit-tested (``merge_statement``); the round
    trip is not run by the tests: it needs a database server.
    """
    props = dict(properties or {})
    props.setdefault("batchsize", "10000")
    updates.write.jdbc(url=url, table=staging_table, mode="overwrite", properties=props)
    merge = merge_statement(table, staging_table, updates.columns, keys, dialect)
    jvm = updates.sparkSession.sparkContext._jvm
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        if k in ("user", "password"):
            jprops.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, jprops)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        stmt.executeUpdate(merge)
        stmt.executeUpdate(f"DROP TABLE {staging_table}")
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()
