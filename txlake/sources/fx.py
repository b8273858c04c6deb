"""Exchange-rate dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.constants import FX_RATES_TO_PLN


def fx_rates(spark: SparkSession) -> DataFrame:
    """``currency, fx_rate_to_pln``: one row per known currency.

    Marked for broadcast here, where its size is known: it is the constant
    table of seven rates. Rates from elsewhere are joined as their size allows.
    """
    values = ", ".join(f"('{code}', {rate}BD)" for code, rate in FX_RATES_TO_PLN.items())
    rates = spark.sql(f"SELECT * FROM VALUES {values} AS fx(currency, fx_rate_to_pln)")
    return F.broadcast(rates)
