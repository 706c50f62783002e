"""DuckDB SQL for every registered query that SQL can express."""

from oracle import answers, ingest, kpis, views

ORACLE: dict[str, str] = {**kpis.ORACLE, **views.ORACLE, **answers.ORACLE, **ingest.ORACLE}
