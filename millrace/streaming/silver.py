"""Bronze to silver: stateless column work, the same for a batch and for a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.numbers import lenient_int
from millrace.functions.texts import initial_caps, pseudonym
from millrace.functions.times import parse_timestamp
from millrace.streaming.ingest import RESCUED

# Fixed value: creation times may have hours of one digit.
CREATION_LAYOUT = "MM-dd-yyyy H:mm:ss"


def silver_users(bronze: DataFrame) -> DataFrame:
    """Name the key, hide the e-mail, parse the dates, tidy the names, cut numbers to int."""
    renamed = bronze.withColumnRenamed("id", "user_id")
    churn = F.col("churn")
    if dict(renamed.dtypes).get("churn") != "boolean":
        churn = churn.try_cast("boolean")
    return renamed.withColumns({
        "email": pseudonym("email"),
        "creation_date": parse_timestamp("creation_date", CREATION_LAYOUT),
        "last_activity_date": parse_timestamp("last_activity_date"),
        "firstname": initial_caps("firstname"),
        "lastname": initial_caps("lastname"),
        "age_group": lenient_int("age_group"),
        "gender": lenient_int("gender"),
        "churn": churn.cast("int"),
    }).drop(RESCUED)


def silver_orders(bronze: DataFrame) -> DataFrame:
    """Name the key and cut numbers to int."""
    return bronze.withColumnRenamed("id", "order_id").withColumns({
        "amount": lenient_int("amount"), "item_count": lenient_int("item_count"),
    }).drop(RESCUED)
