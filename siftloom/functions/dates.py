"""Timestamps from free text: a list of orders is tried, the first that fits wins."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..settings import DATE_ORDERS

# English month names, short or in full; their first three letters tell them apart.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH_NAME = (
    r"jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    r"|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)

_PIECE = rf"(\d{{1,4}}(?:st|nd|rd|th)?|{_MONTH_NAME})"
_SEP = r"[-/., ]+"
_CLOCK = r"(?:[T ,]+(\d{1,2}):(\d{1,2})(?::(\d{1,2}(?:\.\d{1,6})?))?(?:Z|UTC)?)?"
_SHAPE = rf"(?i)^\s*(?:(\d{{8}})|{_PIECE}{_SEP}{_PIECE}{_SEP}{_PIECE}){_CLOCK}\s*$"
_MARK = "\u0001"
_WIDTH = {"y": 4, "m": 2, "d": 2}


def parse_timestamp(c: Column, orders: tuple[str, ...] = DATE_ORDERS) -> Column:
    """Timestamp without time zone from text such as ``01/25/2024`` or ``2024-01-05 10:20``.

    An order names the sequence of year, month and day, and optionally a clock
    part (``ymd HMS``, ``mdy HM``, ``dmy``). Years have four or two digits
    (00-68 are 20xx), months are numbers or English names, and eight digits
    without separators are cut by the order. Dates that cannot exist fall
    through to the next order.

    One regular expression cuts the text into tokens; the orders only differ in
    how they assign them. The tokens are bound to a lambda variable, because
    they are used many times and would be cut anew at each place otherwise.
    """
    cut = F.split(F.regexp_replace(c, _SHAPE, _MARK.join(f"${i}" for i in range(1, 8))), _MARK, -1)
    return F.get(F.transform(F.array(cut), lambda tokens: _assemble(tokens, orders)), F.lit(0))


def _assemble(cut: Column, orders: tuple[str, ...]) -> Column:
    compact, hour, minute, second = (F.get(cut, F.lit(i)) for i in (0, 4, 5, 6))
    clock_kind = F.when(second != "", "HMS").when(hour != "", "HM").otherwise("")

    clocks_by_date_order: dict[str, list[str]] = {}
    for order in orders:
        date_order, _, clock = order.partition(" ")
        clocks_by_date_order.setdefault(date_order, []).append(clock)

    attempts = []
    for date_order, clocks in clocks_by_date_order.items():
        token = {}
        start = 1
        for position, role in enumerate(date_order, start=1):
            width = _WIDTH[role]
            token[role] = F.when(compact == "", F.get(cut, F.lit(position))).otherwise(
                F.substring(compact, start, width))
            start += width
        year, month, day = _year(token["y"]), _month(token["m"]), _day(token["d"])
        # Ranges and blanks are checked first: a failed conversion raises inside, which is slow.
        plausible = ((F.size(cut) == 7) & clock_kind.isin(*clocks)
                     & (month >= 1) & (month <= 12) & (day >= 1) & (day <= 31))
        attempts.append(F.when(plausible, F.try_make_timestamp_ntz(
            year, month, day,
            F.when(hour != "", hour.try_cast("int")).otherwise(0),
            F.when(minute != "", minute.try_cast("int")).otherwise(0),
            F.when(second != "", second.try_cast("decimal(16,6)")).otherwise(F.lit(0).cast("decimal(16,6)")))))
    return F.coalesce(*attempts)


def _year(token: Column) -> Column:
    number = token.try_cast("int")
    return (F.when(F.length(token) == 4, number)
            .when((F.length(token) == 2) & (number <= 68), number + 2000)
            .when(F.length(token) == 2, number + 1900))


def _month(token: Column) -> Column:
    by_name = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(F.lower(token), 1, 3))
    return F.when(F.length(token) <= 2, token.try_cast("int")).when(by_name > 0, by_name.cast("int"))


def _day(token: Column) -> Column:
    digits = F.regexp_replace(token, r"(?i)(?:st|nd|rd|th)$", "")
    return F.when(F.length(digits) <= 2, digits.try_cast("int"))


def timestamp_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
