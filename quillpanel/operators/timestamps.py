"""Problem 6: mixed timestamp formats and time zones.

Every cell is read by one of six patterns (one regular-expression pass each, JVM-side) into a written local
date-time plus what it says about its zone. A zone that is not written comes from the row's place; where the
place is missing too, it is estimated: local times are aligned with the ingestion times, and of all candidate
offset histories (IANA zones) the one with the fewest violations is chosen, first for the row itself where its
own evidence decides, else for its sequence (a group of rows from one source).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillpanel.session import let, qcol, stored

# Month names, as written in English and French, by number.
MONTHS = {
    1: "jan january janv janvier",
    2: "feb february fév févr fevr février fevrier",
    3: "mar march mars",
    4: "apr april avr avril",
    5: "may mai",
    6: "jun june juin",
    7: "jul july juil juillet",
    8: "aug august aoû août aout",
    9: "sep sept september septembre",
    10: "oct october octobre",
    11: "nov november novembre",
    12: "dec december déc décembre decembre",
}
# Zone abbreviations and their minutes east of UTC.
ZONE_MINUTES = {"z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "wat": 60, "cet": 60, "west": 60, "bst": 60, "cest": 120, "eet": 120, "cat": 120, "eest": 180, "eat": 180, "msk": 180}
# Counts of time units by (seconds from 1970 of their zero, units in a second).
DAY_US = 86_400_000_000
COUNT_ORIGINS_S = {"unix": 0, "stata": -315_619_200, "excel": -2_209_161_600}
COUNT_UNITS_US = {"day": DAY_US, "second": 1_000_000, "milli": 1_000, "micro": 1}

_TIME = r"(?:(?:[t,]|\s+(?:à|at)\s|\s)\s*(\d{1,2})[:h](\d{2})(?:[:m](\d{2})(?:[.,](\d{1,9}))?)?s?\s*([ap])?(?:\.?m\b\.?)?)?"
_ZONE = r"\s*([a-z]{1,5}|(?:utc|gmt)?[+\-−]\d{2}:?\d{2})?\s*(?:\[([^\]]+)\])?$"
_SEP = "\x01"
# The patterns a written time can follow, each with the places of year, month, day, the sign
# between them, hour, minute, second, fraction, half of the day, zone sign and zone name among its groups
# (0: has none).
_FORMS = {
    r"^\d{4}[-/.]": (r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})" + _TIME + _ZONE, (1, 3, 4, 2, 5, 6, 7, 8, 9, 10, 11)),
    r"^\d{1,2}[-/.]\d": (r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4}|\d{2})" + _TIME + _ZONE, (4, 3, 1, 2, 5, 6, 7, 8, 9, 10, 11)),
    r"^\d{1,2}(?:er)?[- ]+\p{L}": (r"^(\d{1,2})(?:er)?[- ]+(\p{L}+)\.?[-, ]+(\d{4}|\d{2})" + _TIME + _ZONE, (3, 2, 1, 0, 4, 5, 6, 7, 8, 9, 10)),
    r"^\p{L}{3}": (r"^(\p{L}+)\.?[- ]+(\d{1,2})(?:st|nd|rd|th)?,?[- ]+(\d{4})" + _TIME + _ZONE, (3, 1, 2, 0, 4, 5, 6, 7, 8, 9, 10)),
    r"^20\d{2}[01]\d[0-3]\d(?:\D|$|[0-2]\d[0-5]\d(?:$|\D|[0-5]\d(?:\D|$)))": (
        r"^(\d{4})(\d{2})(\d{2})(?:[t ]?(\d{2})(\d{2})(\d{2})?(?:[.,](\d{1,9}))?)?(z|[+\-]\d{2}:?\d{2})?$",
        (1, 2, 3, 0, 4, 5, 6, 7, 0, 8, 0),
    ),
}
_COUNT = r"^\d{4,19}(?:\.\d{1,9})?$"
_CANONICAL_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{6}Z$"
_CANONICAL_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def plain_text(cell: Column) -> Column:
    """Lower case, ASCII digits, plain and single blanks, no invisible signs, trimmed. Linear in the cell's length, and so
    are the patterns on its result, where no run of blanks is left to try in many ways."""
    digits = "".join(chr(start + d) for start in (0x660, 0x6F0, 0xFF10) for d in range(10))
    marks, plain = "\u00a0\u2007\u2009\u202f\u3000：／－", "     :/-"
    hidden = "\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
    usual = cell.rlike(r"^[\x20-\x7e]*$") & ~F.contains(cell, F.lit("  "))
    unified = F.translate(cell, digits + marks + hidden, "0123456789" * 3 + plain)
    return F.lower(F.trim(F.when(usual, cell).otherwise(F.regexp_replace(unified, r"\s++", " "))))


def _month_number(name: Column) -> Column:
    pairs = [F.lit(x) for number, names in MONTHS.items() for spelling in names.split() for x in (spelling, number)]
    return F.when(name.rlike("^[0-9]"), name.try_cast("int")).otherwise(F.try_element_at(F.create_map(*pairs), name))


def _minutes_east(mark: Column) -> Column:
    named = F.try_element_at(F.create_map(*[F.lit(x) for kv in ZONE_MINUTES.items() for x in kv]), mark)
    digits = F.regexp_replace(mark, r"\D", "")
    size = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    return F.when(F.length(digits) == 4, F.when(mark.rlike("[-−]"), -size).otherwise(size)).otherwise(named)


def _day_number(year: Column, month: Column, day: Column) -> Column:
    """Days since 1970-01-01; NULL for a day no calendar has."""
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    longest = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    real = year.between(1, 9999) & month.between(1, 12) & (day >= 1) & (day <= longest)
    return F.datediff(F.when(real, F.make_date(year, month, day)), F.lit("1970-01-01").cast("date"))


def _counted(text: Column, years: tuple[int, int]) -> Column:
    """A plain count of time units from a known origin, in microseconds since 1970: the reading that falls into ``years``."""
    value = text.try_cast("decimal(28,9)")
    low, high = ((date(y, 1, 1) - date(1970, 1, 1)).days * DAY_US for y in (years[0], years[1] + 1))
    readings = []
    for unit, scale in COUNT_UNITS_US.items():
        for origin in COUNT_ORIGINS_S.values():
            if unit == "day" or origin != COUNT_ORIGINS_S["excel"]:
                # bounds before arithmetic: only a value that lands in the window is multiplied
                least, most = ((x - origin * 1_000_000) / scale for x in (low, high))
                readings.append(F.when((value >= F.lit(least)) & (value < F.lit(most)), F.round(value * scale, 0).cast("bigint") + F.lit(origin * 1_000_000)))
    return F.coalesce(*readings)


def read_cells(df: DataFrame, text: str, month_first: str, years: tuple[int, int]) -> DataFrame:
    """The rows of ``df`` whose cell ``text`` denotes a time, with days (since 1970), us_of_day, offset_us, zone, utc_us.

    Missing-value marks, impossible dates and anything unreadable give no row; cells of any length are read whole.
    Only plain projections, each step computed once and compiled."""
    plain = df.withColumn("__t", plain_text(qcol(text)))
    t, unified = F.col("__t"), None
    for probe, (pattern, places) in _FORMS.items():
        one = F.regexp_replace(t, pattern, _SEP.join(f"${i}" if i else "" for i in places))
        unified = F.when(t.rlike(probe), one) if unified is None else unified.when(t.rlike(probe), one)
    parts = plain.withColumn("__p", F.split(unified, _SEP, -1)).withColumn("__us", F.when(t.rlike(_COUNT), _counted(t, years)))
    get = lambda i: F.get(F.col("__p"), F.lit(i))
    number = lambda c: F.when(c == "", 0).otherwise(c.try_cast("int"))
    swap = qcol(month_first) & (get(3) == "/") & ~t.rlike(r"^\d{4}")
    fields = parts.withColumns(
        {
            "__y": F.when(F.length(get(0)) == 2, get(0).try_cast("int") + 2000).otherwise(get(0).try_cast("int")),
            "__mo": F.when(swap, get(2).try_cast("int")).otherwise(_month_number(get(1))),
            "__d": F.when(swap, get(1).try_cast("int")).otherwise(get(2).try_cast("int")),
            "__h": number(get(4)),
            "__half": get(8),
            "__min": number(get(5)),
            "__s": number(get(6)),
            "__frac": F.when(get(7) == "", 0).otherwise(F.rpad(F.substring(get(7), 1, 6), 6, "0").try_cast("bigint")),
            "__mark": get(9),
            "zone": F.when(get(10) != "", get(10)),
        }
    )
    h, half, mark = F.col("__h"), F.col("__half"), F.col("__mark")
    hour = F.when(half == "", h).when((h >= 1) & (h <= 12), h % 12 + F.when(half == "p", 12).otherwise(0))
    clock = fields.withColumns(
        {
            "__days": _day_number(F.col("__y"), F.col("__mo"), F.col("__d")),
            "__hour": hour,
            "offset_us": F.when(mark != "", _minutes_east(mark).cast("bigint") * 60_000_000),
        }
    )
    valid = F.col("__days").isNotNull() & (F.col("__hour") < 24) & (F.col("__min") < 60) & (F.col("__s") < 60) & ((mark == "") | F.col("offset_us").isNotNull())
    of_day = ((F.col("__hour") * 60 + F.col("__min")) * 60 + F.col("__s")).cast("bigint") * 1_000_000 + F.col("__frac")
    counted = F.col("__us")
    days = F.coalesce(F.when(valid, F.col("__days")), F.floor(counted / DAY_US).cast("int"))
    said = F.struct(
        days.alias("days"),
        F.when(valid, of_day).otherwise(F.pmod(counted, F.lit(DAY_US))).alias("us_of_day"),
        F.when(valid, F.col("offset_us")).alias("offset_us"),
        F.when(valid, F.col("zone")).alias("zone"),
        F.when(~valid | F.col("__days").isNull(), counted).alias("utc_us"),
    )
    # unread cells leave in a generator: a filter would be pushed below and repeat the reading
    return clock.select(*(qcol(c) for c in df.columns), F.inline(F.array_compact(F.array(F.when(days.isNotNull(), said)))))


def local_us() -> Column:
    return F.col("days").cast("bigint") * DAY_US + F.col("us_of_day")


def local_to_utc(us: Column, zone: Column) -> Column:
    """Instant of a local time; one that occurs twice means the first, one that is skipped moves forward."""
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(us), zone))


def _violation(local: Column, zone: str, ingested: Column, tolerance_us: int) -> Column:
    lag = ingested - local_to_utc(local, F.lit(zone))
    return ((lag < 0) | (lag > tolerance_us)).cast("int")


def _zone_costs(local: Column, ingested: Column, candidates: Sequence[str], tolerance_us: int) -> list[Column]:
    """Aggregates: the violations of each candidate, v0 and on; NULL where there is no evidence."""
    return [F.sum(_violation(local, z, ingested, tolerance_us)).alias(f"v{i}") for i, z in enumerate(candidates)]


def _cheapest(candidates: Sequence[str]) -> Column:
    """The candidate with the fewest violations, the first of equal ones; NULL without evidence."""
    ranked = F.array_min(F.array(*(F.struct(F.col(f"v{i}").alias("v"), F.lit(i).alias("i")) for i in range(len(candidates)))))
    return F.when(F.col("v0").isNotNull(), F.element_at(F.array(*map(F.lit, candidates)), ranked["i"] + 1))


def estimate_zones(evidence: DataFrame, group: str, local: str, ingested: str, candidates: Sequence[str], tolerance_us: int = 3_600_000_000) -> DataFrame:
    """For each ``group`` the candidate offset history with the fewest violations.

    A violation is a local time that, read in the candidate, lies after its ingestion or more than
    ``tolerance_us`` before it. Ties go to the candidate named first. Partial aggregates only, so a group may be
    of any size. NULL groups form one group. Returns (group, est_zone)."""
    costs = evidence.groupBy(qcol(group)).agg(*_zone_costs(qcol(local), qcol(ingested), candidates, tolerance_us))
    return costs.select(qcol(group), _cheapest(candidates).alias("est_zone"))


def normalize_times(
    df: DataFrame,
    key: str,
    time_fields: Sequence[str],
    date_fields: Sequence[str],
    *,
    places: DataFrame,
    place: str,
    zone: str,
    sequence: Column,
    ingested: str,
    anchor: str,
    month_first: Column,
    years: tuple[int, int],
    own_tolerance_us: int = 1_800_000_000,
    max_zones: int = 600,
) -> DataFrame:
    """(key, field, utc_us): one row for each cell that denotes a time or date and isn't yet in the one form.

    places: table of ``place`` and IANA ``zone``. sequence: expression naming the source a row came from, used
    where the place is unknown. anchor: the time field written shortly before ``ingested``. years: the years in which
    plain counts of time units can lie, which tells their unit and origin.
    Cells that are NULL, empty, missing-value marks, impossible or unreadable give no row. Ambiguous local times
    mean the first occurrence. Equal rows each give their rows; an empty table gives none. The distinct zones are
    read to the driver: they are names of the IANA database, fewer than ``max_zones``, else ValueError.

    What the rows say about each sequence's zone is aggregated first (of rows with a place only that is read, of the
    others the anchor) and written as a table of one row for each sequence; then all cells are read in one pass, which
    joins that table by its real size."""
    zones = [r[0] for r in places.select(qcol(zone)).filter(qcol(zone).isNotNull()).groupBy(qcol(zone)).count().orderBy(F.desc("count"), qcol(zone)).limit(max_zones + 1).collect()]
    if len(zones) > max_zones:
        raise ValueError(f"more than {max_zones} zones in the table of places")
    zones = zones or ["UTC"]
    lookup = places.groupBy(qcol(place).alias("__place")).agg(F.min(qcol(zone)).alias("__zone"))
    fields = [*time_fields, *date_fields]
    rows = df.select(
        qcol(key),
        qcol(place).alias("__at"),
        sequence.alias("__sequence"),
        F.unix_micros(qcol(ingested).cast("timestamp")).alias("__ingested") if dict(df.dtypes)[ingested] == "timestamp" else _ntz_micros(qcol(ingested)).alias("__ingested"),
        month_first.alias("__month_first"),
        *(qcol(f) for f in fields),
    )

    def cell(name: str) -> Column:
        form = _CANONICAL_DATE if name in date_fields else _CANONICAL_TIME
        return F.when(qcol(name).isNotNull() & ~qcol(name).rlike(form), F.struct(F.lit(name).alias("field"), qcol(name).alias("text")))

    zoned = rows.join(lookup, F.col("__at") == F.col("__place"), "left")
    lost = F.col("__zone").isNull()
    zoneless = F.col("offset_us").isNull() & F.col("zone").isNull() & F.col("utc_us").isNull()

    # evidence: where the place is known, its zone counts; elsewhere the anchor's violations do
    witness = zoned.filter(lost).select("__sequence", "__ingested", "__month_first", cell(anchor)["text"].alias("__text")).filter("__text IS NOT NULL")
    told = read_cells(witness, "__text", "__month_first", years).filter(zoneless).select("__sequence", F.lit(None).cast("string").alias("__zone"), local_us().alias("__local"), "__ingested")
    located = zoned.filter(~lost).select("__sequence", "__zone", F.lit(None).cast("bigint").alias("__local"), F.lit(None).cast("bigint").alias("__ingested"))
    counts = [F.sum((F.col("__zone") == z).cast("long")).alias(f"n{i}") for i, z in enumerate(zones)]
    evidence = located.unionByName(told).groupBy("__sequence").agg(*counts, *_zone_costs(F.col("__local"), F.col("__ingested"), zones, 3_600_000_000))
    usual = F.array_max(F.array(*(F.struct(F.col(f"n{i}").alias("n"), F.lit(-i).alias("i")) for i in range(len(zones)))))
    usual_zone = F.when(usual["n"] > 0, F.element_at(F.array(*map(F.lit, zones)), 1 - usual["i"]))
    name = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))  # noqa: E731  NULL is a sequence, too
    near = stored(evidence.select(name(F.col("__sequence")).alias("__seq"), F.coalesce(_cheapest(zones), usual_zone).alias("__est")))

    # every cell, in one pass
    placed = zoned.withColumn("__look", F.when(lost, name(F.col("__sequence")))).join(near, F.col("__look") == F.col("__seq"), "left")
    stacked = placed.select(qcol(key), "__ingested", "__month_first", "__zone", "__est", F.explode(F.array_compact(F.array(*(cell(f) for f in fields)))).alias("__c"))
    open_cells = stacked.select(qcol(key), "__ingested", "__month_first", "__zone", "__est", F.col("__c.field").alias("field"), F.col("__c.text").alias("__text"))
    read = read_cells(open_cells, "__text", "__month_first", years)
    fitting = F.filter(
        F.array(*(F.struct(_violation(local_us(), z, F.col("__ingested"), own_tolerance_us).alias("v"), F.lit(z).alias("z")) for z in zones)),
        lambda x: x["v"] == 0,
    )
    # a row without a place: what its own anchor says, then what its sequence says
    only = let(fitting, lambda z: F.when(F.size(z) == 1, F.get(z, F.lit(0))["z"]))
    decided = F.when(lost & (F.col("field") == anchor) & zoneless, only)
    zone_of = F.coalesce(F.col("__zone"), decided, F.col("__est"), F.lit(zones[0]))
    dated = F.col("field").isin(*date_fields) if date_fields else F.lit(False)
    utc = (
        F.when(dated, F.col("days").cast("bigint") * DAY_US)
        .when(F.col("utc_us").isNotNull(), F.col("utc_us"))
        .when(F.col("offset_us").isNotNull(), local_us() - F.col("offset_us"))
        .otherwise(local_to_utc(local_us(), zone_of))
    )
    return read.select(qcol(key), "field", utc.alias("utc_us"))


def _ntz_micros(c: Column) -> Column:
    """Microseconds of a zone-less timestamp read as UTC, whatever the session's zone."""
    day = F.to_date(c)
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint") * DAY_US + (
        (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint") * 1_000_000 + F.round(F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    )
