"""The SQL that problem 6 is checked with: every form read by a pattern with named groups, zones by the database's own
calendar, places that are unknown by counting violations as joins."""

from __future__ import annotations

_TIME = r"(?:[t, ]+(?:à |at )?([0-9]{1,2})[:h]([0-9]{2})(?:[:m]([0-9]{2})(?:[.,]([0-9]{1,9}))?)?s? ?([ap]?)(?:\.?m\.?)?)?"
_ZONE = r" ?([a-z]{1,5}|(?:utc|gmt)?[+−-][0-9]{2}:?[0-9]{2})? ?(?:\[([^\]]+)\])?$"
# pattern and the names of its groups
_FORMS = {
    "ymd": (r"^([0-9]{4})([-/.])([0-9]{1,2})[-/.]([0-9]{1,2})" + _TIME + _ZONE, "y sep m d h mi s f half mark zone"),
    "dmy": (r"^([0-9]{1,2})([-/.])([0-9]{1,2})[-/.]([0-9]{4}|[0-9]{2})" + _TIME + _ZONE, "d sep m y h mi s f half mark zone"),
    "dmony": (r"^([0-9]{1,2})(?:er)?[- ]+(\p{L}+)\.?[-, ]+([0-9]{4}|[0-9]{2})" + _TIME + _ZONE, "d m y h mi s f half mark zone"),
    "mondy": (r"^(\p{L}+)\.?[- ]+([0-9]{1,2})(?:st|nd|rd|th)?,?[- ]+([0-9]{4})" + _TIME + _ZONE, "m d y h mi s f half mark zone"),
    "tight": (r"^(20[0-9]{2})([01][0-9])([0-3][0-9])(?:[t ]?([0-9]{2})([0-9]{2})([0-9]{2})?(?:[.,]([0-9]{1,9}))?)?(z|[+-][0-9]{2}:?[0-9]{2})?$", "y m d h mi s f mark"),
}
_PARTS = "y m d h mi s f half mark zone sep".split()


def _form(n: str) -> str:
    pattern, listed = _FORMS[n]
    names = listed.split()
    g = f"regexp_extract(t, '{pattern}', {names})"
    return "{" + ", ".join(f"'{k}': " + (f"({g}).{k}" if k in names else "''") for k in _PARTS) + f", 'form': '{n}'}}"


# How months begin, without accents, in English and French; zone abbreviations and their minutes east.
_MONTHS = {"jan": 1, "feb": 2, "fev": 2, "mar": 3, "apr": 4, "avr": 4, "may": 5, "mai": 5, "jun": 6, "juin": 6, "jul": 7, "juil": 7, "aug": 8, "aou": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12}
_ZONES = {"z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "wat": 60, "cet": 60, "west": 60, "bst": 60, "cest": 120, "eet": 120, "cat": 120, "eest": 180, "eat": 180, "msk": 180}
_MONTH = "CASE WHEN m SIMILAR TO '[0-9]+' THEN CAST(m AS INT) " + " ".join(f"WHEN starts_with(strip_accents(m), '{k}') THEN {v}" for k, v in sorted(_MONTHS.items(), key=lambda x: -len(x[0]))) + " END"
_NAMED = " ".join(f"WHEN mark = '{k}' THEN {v}" for k, v in _ZONES.items())
_DAY = 86_400_000_000
# microseconds of a unit, and the second of its zero; counts lie in 2016 to 2020
_UNITS = ((_DAY, 0), (_DAY, -315619200), (_DAY, -2209161600), (1_000_000, 0), (1_000_000, -315619200), (1_000, 0), (1_000, -315619200), (1, 0), (1, -315619200))
_FROM, _TO = 1_451_606_400_000_000, 1_609_459_200_000_000
_COUNT = "coalesce(" + ", ".join(f"CASE WHEN n * {u} + {o}000000 >= {_FROM} AND n * {u} + {o}000000 < {_TO} THEN CAST(round(n * {u}) AS BIGINT) + {o}000000 END" for u, o in _UNITS) + ")"


def _utc(local: str, zone: str) -> str:
    """A local time that occurs twice means the first: the earlier of it and an hour after the hour before it."""
    at = lambda x: f"epoch_us(timezone({zone}, make_timestamp({x})))"
    return f"least({at(local)}, {at(local + ' - 3600000000')} + 3600000000)"


SQL = rf"""
    WITH zs AS (SELECT zone_name AS z, row_number() OVER (ORDER BY count(*) DESC, zone_name) AS r FROM locations WHERE zone_name IS NOT NULL GROUP BY 1),
    a AS (SELECT row_id, epoch_us(received_at) AS got, coalesce(form_lang = 'en', false) AS en, l.zone_name AS place_zone, regexp_extract(upper(st_id), '([ABS])[^A-Z]*R[^A-Z]*E[^A-Z]*M', 1) AS seq,
                 unnest([{{'field': 'start_time', 'x': start_time}}, {{'field': 'submission_time', 'x': submission_time}}, {{'field': 'entry_date', 'x': entry_date}}]) AS c FROM assessments LEFT JOIN locations l USING (location_id)),
    b AS (SELECT row_id, got, en, place_zone, seq, c.field AS field, lower(trim(regexp_replace(translate(c.x, '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹０１２３４５６７８９：／－' || chr(160) || chr(8199) || chr(8201) || chr(8239) || chr(12288), '012345678901234567890123456789:/-     '), '\s+', ' ', 'g'))) AS t0
          FROM a WHERE c.x IS NOT NULL AND NOT regexp_full_match(c.x, CASE c.field WHEN 'entry_date' THEN '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}' ELSE '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}[.][0-9]{{6}}Z' END)),
    t AS (SELECT * EXCLUDE t0, trim(regexp_replace(t0, '[\x{{200b}}-\x{{200f}}\x{{2060}}\x{{feff}}]', '', 'g')) AS t FROM b),
    f AS (SELECT *, CASE WHEN regexp_matches(t, '^[0-9]{{4}}[-/.]') THEN {_form("ymd")} WHEN regexp_matches(t, '^[0-9]{{1,2}}[-/.][0-9]') THEN {_form("dmy")} WHEN regexp_matches(t, '^[0-9]{{1,2}}(er)?[- ]+\p{{L}}') THEN {_form("dmony")}
              WHEN regexp_matches(t, '^\p{{L}}{{3}}') THEN {_form("mondy")} ELSE {_form("tight")} END AS p, CASE WHEN regexp_full_match(t, '[0-9]{{4,19}}([.][0-9]{{1,9}})?') THEN CAST(t AS DECIMAL(29, 9)) END AS n0 FROM t),
    g AS (SELECT row_id, got, en, place_zone, seq, field, p.* , CAST(n0 AS DOUBLE) AS n FROM f),
    h AS (SELECT *, {_COUNT} AS counted, en AND sep = '/' AND form = 'dmy' AS swap, TRY_CAST(y AS INT) + CASE WHEN length(y) = 2 THEN 2000 ELSE 0 END AS yy, {_MONTH} AS mm, TRY_CAST(d AS INT) AS dd,
              CASE WHEN h = '' THEN 0 ELSE CAST(h AS INT) END AS hh FROM g),
    k AS (SELECT *, CASE WHEN half = '' THEN hh WHEN hh BETWEEN 1 AND 12 THEN hh % 12 + CASE half WHEN 'p' THEN 12 ELSE 0 END END AS hour, coalesce(TRY_CAST(mi AS INT), 0) AS mins, coalesce(TRY_CAST(s AS INT), 0) AS secs,
              CASE WHEN f = '' THEN 0 ELSE CAST(rpad(left(f, 6), 6, '0') AS BIGINT) END AS us,
              TRY_CAST(printf('%04d-%02d-%02d', yy, CASE WHEN swap THEN dd ELSE mm END, CASE WHEN swap THEN mm ELSE dd END) AS DATE) AS day,
              CASE {_NAMED} WHEN mark <> '' THEN (CAST(right(regexp_replace(mark, '[^0-9]', '', 'g'), 2) AS INT) + 60 * CAST(left(regexp_replace(mark, '[^0-9]', '', 'g'), 2) AS INT)) * CASE WHEN regexp_matches(mark, '[-−]') THEN -1 ELSE 1 END END AS east FROM h),
    m AS (SELECT *, day IS NOT NULL AND hour < 24 AND mins < 60 AND secs < 60 AND (mark = '' OR east IS NOT NULL) AS good, epoch_us(CAST(day AS TIMESTAMP)) + ((hour * 60 + mins) * 60 + secs)::BIGINT * 1000000 + us AS local FROM k),
    o AS (SELECT *, field = 'submission_time' AND place_zone IS NULL AND good AND mark = '' AND zone = '' AS anchor FROM m WHERE good OR counted IS NOT NULL),
    fit AS (SELECT o.row_id, o.seq, zs.z, zs.r, got - {_utc("local", "zs.z")} AS lag FROM o, zs WHERE anchor),
    own AS (SELECT row_id, any_value(z) AS z FROM fit WHERE lag BETWEEN 0 AND 1800000000 GROUP BY row_id HAVING count(*) = 1),
    lost AS (SELECT seq, arg_min(z, r) AS z FROM (SELECT seq, z, r, sum(CASE WHEN lag BETWEEN 0 AND 3600000000 THEN 0 ELSE 1 END) AS v FROM fit GROUP BY seq, z, r QUALIFY v = min(v) OVER (PARTITION BY seq)) GROUP BY seq),
    usual AS (SELECT seq, arg_min(z, r) AS z FROM (SELECT seq, place_zone AS z, r, count(*) AS n FROM a JOIN zs ON zs.z = place_zone WHERE c.field = 'start_time' GROUP BY seq, place_zone, r QUALIFY n = max(n) OVER (PARTITION BY seq)) GROUP BY seq),
    e AS (SELECT o.*, coalesce(place_zone, CASE WHEN field = 'submission_time' THEN own.z END, lost.z, usual.z, (SELECT z FROM zs WHERE r = 1)) AS zz FROM o LEFT JOIN own ON own.row_id = o.row_id AND o.anchor LEFT JOIN lost USING (seq) LEFT JOIN usual USING (seq))
    SELECT row_id, field, CASE WHEN field = 'entry_date' THEN coalesce(CASE WHEN good THEN epoch_us(CAST(day AS TIMESTAMP)) END, counted - (counted % {_DAY} + {_DAY}) % {_DAY}) WHEN NOT good THEN counted WHEN mark <> '' THEN local - east * 60000000::BIGINT ELSE {_utc("local", "zz")} END AS utc_us FROM e"""
