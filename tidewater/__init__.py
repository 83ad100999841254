"""tidewater: a Spark-native medallion warehouse (bronze -> silver -> gold)
with analytics and data-quality checks, written with the PySpark DataFrame API.

Layout
------
- ``sources``   readers (CSV, raw lines, parquet test tables), sinks, load audit
- ``functions`` Column -> Column helpers (text cleaning, date parsing, integer average)
- ``operators`` DataFrame -> DataFrame building blocks (dedupe, global row number, NTILE)
- ``plans``     the warehouse jobs: silver transforms, gold models, EDA, advanced
                analytics and the declarative quality suite; layer jobs and catalog
                registration (``plans.warehouse``); named queries with their SQL
                oracles (``plans.registry``)
- ``run``       ``python -m tidewater.run --sf-dir DIR --out SHARED_DIR``: the whole pipeline
"""

from tidewater.session import build_session, staging_path

__all__ = ["build_session", "staging_path"]
