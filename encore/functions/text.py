"""Text built from records (JVM-side expressions only)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed texts of the ticket confirmation message.
SENDER = "tickets@example.com"     # sender address: our own neutral value
RECIPIENT_DOMAIN = "@email.com"
SUBJECT_PREFIX = "Ticket Confirmation ("
SUBJECT_MIDDLE = ") - Event "
BODY_PREFIX = "Your ticket has been "
BODY_SUFFIX = "!"


def address_line(prefix: str = "") -> Column:
    """``line1, line2, city, STATE zip5-zip4 country``; a missing part prints ``null``."""
    c = lambda n: F.col(prefix + n)
    return F.format_string("%s, %s, %s, %s %s-%s %s", c("line1"), c("line2"), c("citynm"),
                           c("state"), c("zip5"), c("zip4"), c("countrycd"))


def notification_columns(customerid: Column, confirmationid: Column, eventid: Column,
                         status: Column) -> list[Column]:
    return [
        F.lit(SENDER).alias("sender"),
        F.concat(customerid.cast("string"), F.lit(RECIPIENT_DOMAIN)).alias("recipient"),
        F.concat(F.lit(SUBJECT_PREFIX), confirmationid, F.lit(SUBJECT_MIDDLE),
                 eventid.cast("string")).alias("subject"),
        F.concat(F.lit(BODY_PREFIX), status, F.lit(BODY_SUFFIX)).alias("body"),
    ]
