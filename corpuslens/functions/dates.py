"""Date parsing that never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted layouts by the shape of the text. A layout that does not fit costs an exception inside Spark, so the
# shape picks the few that can. Slashes with the year last mean month first, and day first where that cannot be.
LAYOUTS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", ("yyyy-M-d",)),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d", ("yyyy-M-d H:mm:ss[.SSSSSS][XXX]", "yyyy-M-d H:mm")),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d", ("yyyy-M-d'T'H:mm:ss[.SSSSSS][.SSS][XXX]", "yyyy-M-d'T'H:mm[XXX]")),
    (r"^\d{4}/\d", ("yyyy/M/d", "yyyy/M/d H:mm:ss", "yyyy/M/d H:mm")),
    (r"^\d{1,2}/\d{1,2}/\d{4}", ("M/d/yyyy", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "d/M/yyyy", "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm")),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}", ("d.M.yyyy",)),
    (r"^[A-Za-z]{3,9}\.? \d", ("MMMM d, yyyy", "MMM d, yyyy", "MMMM d yyyy", "MMM d yyyy")),
    (r"^\d{1,2} [A-Za-z]", ("d MMMM yyyy", "d MMM yyyy")),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{2}$", ("d-MMM-yy",)),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", ("d-MMM-yyyy",)),
)


def parse_date(text: Column) -> Column:
    """First layout that fits, else null. Times without a zone are in the session's."""
    value = F.trim(text.cast("string"))
    parsed = F.lit(None).cast("timestamp")
    for shape, layouts in reversed(LAYOUTS):
        fits = F.coalesce(*[F.try_to_timestamp(value, F.lit(layout)) for layout in layouts])
        parsed = F.when(value.rlike(shape), fits).otherwise(parsed)
    return parsed
