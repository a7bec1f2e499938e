"""Attributes that need match positions, as pandas UDFs over Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf, udtf

# --- Fixed values: words of experience requirements ----------------------------------------------------------------------
YEARS = r"years?|yrs?|Jahre?n?|ans?|anni?|años?|jaar|år"
MONTHS = r"months?|Monate?n?|mois|mesi|meses|maanden|månader|måneder"
EXPERIENCE = r"experience|exp\b|Erfahrung|Berufserfahrung|expérience|esperienza|experiencia|ervaring|erfarenhet|erfaring"
FIELDS = r"management|development|engineering|leadership|consulting|work(?:ing)?\s+in"
LINKS = r"(?:(?:of|di|de|an|van)\s+|d['’]\s*)"
NOT_OURS = (
    r"has been|have been|founded|established|since\s+\d|for over|for more than|operating|history of|track record of|we.ve been|we have|our company|celebrating|supports? our|in the industry|on the market|"
    r"sentence|imprisonment|prison|warranty|guarantee"
)
MOST_YEARS = 30

_N, _U = r"\d{1,2}(?:[.,]\d)?", rf"(?:{YEARS}|{MONTHS})"
_ASKED = rf"\s+{LINKS}?(?:[\w-]+\s+){{0,4}}?(?:{EXPERIENCE}|{FIELDS})"
#: Forms of a requirement, each with low and unit, and high and low_unit where it has them.
_FORMS = [
    re.compile(x, re.I)
    for x in (
        rf"(?<![\d.])(?P<low>{_N})\s*(?P<low_unit>{MONTHS})\s*(?:to|[-–—])\s*(?P<high>{_N})\s*(?P<unit>{_U}){_ASKED}",
        rf"(?<![\d.])(?P<low>{_N})\s*(?:[+＋]|(?:[-–—]|to)\s*(?P<high>{_N})\s*[+＋]?)?\s*(?P<unit>{_U})['’s]*{_ASKED}",
        rf"(?<![\d.])(?P<low>{_N})\s*(?:-|–|to)\s*(?P<high>{_N})\s*\+?\s*(?P<unit>years?|yrs?|months?)",
        rf"(?:{EXPERIENCE})\s+(?:von\s+)?(?:mindestens\s+|d['’]\s*(?:au\s+moins\s+)?|di\s+(?:almeno\s+)?|de\s+(?:al\s+menos\s+|au\s+moins\s+)?|van\s+(?:minimaal\s+)?)?(?<![\d.])(?P<low>{_N})\s*(?:[+＋]|[-–—]\s*(?P<high>{_N}))?\s*(?P<unit>{_U})",
        rf"experience\s*(?:required|level)?\s*[:\-]\s*(?P<low>{_N})\s*\+?\s*(?P<unit>years?|yrs?|months?)",
    )
]
_OTHERS = re.compile(NOT_OURS, re.I)
_MONTH = re.compile(MONTHS, re.I)


def _years(number: str, unit: str) -> float:
    """Years to a tenth, half up."""
    tenths = Decimal(number.replace(",", ".")) / (12 if _MONTH.fullmatch(unit) else 1)
    return float(tenths.quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))


def required_years(text: str | None) -> float | None:
    found = []
    for form in _FORMS:
        for m in form.finditer(text or ""):
            g = m.groupdict()
            low = _years(g["low"], g.get("low_unit") or g["unit"])
            high = _years(g["high"], g["unit"]) if g.get("high") else low
            if low <= high <= MOST_YEARS and not _OTHERS.search(text[max(0, m.start() - 60) : m.start()]):
                found.append(low)
    return max(found, default=None)


@pandas_udf(T.DoubleType())
def years_of_experience(text: pd.Series) -> pd.Series:
    """The largest of the least years that a text asks for, in English, German, French, Italian, Spanish, Dutch, Swedish,
    Danish and Norwegian: "5+ years of experience", ranges (months to years too) and the reversed order ("Erfahrung von
    5 Jahren"). Months count as twelfths, to a tenth; ranges that fall, more than 30 years, and company histories (in the
    60 characters before) do not count; null if none."""
    return text.map(required_years).astype("float64")


# --- Fixed values: marks of currencies before and after an amount, in the order in which families are tried ----------
DOLLARS = {"US": "USD", "U": "USD", "AU": "AUD", "A": "AUD", "NZ": "NZD", "HK": "HKD", "S": "SGD", "R": "BRL", "MX": "MXN", "CDN": "CAD", "CA": "CAD", "C": "CAD"}
DOLLAR_CODES = ("AUD", "NZD", "SGD", "HKD", "BRL", "MXN", "CAD", "USD")
MARKS = {
    "EUR": (("€", "EUR"), ("€", "EUR", "Euro", "euros")), "GBP": (("£", "GBP"), ("£", "GBP")), "CHF": (("CHF", "SFr."), ("CHF", "Fr.", "Franken", "francs suisses")),
    "PLN": (("PLN", "zł"), ("PLN", "zł", "złotych")), "CZK": (("CZK", "Kč"), ("CZK", "Kč", "korun")), "SEK": (("SEK",), ("SEK", "kronor")), "DKK": (("DKK",), ("DKK", "kroner")),
    "HUF": (("HUF", "Ft"), ("HUF", "Ft", "forint")), "RON": (("RON",), ("RON", "lei")), "BGN": (("BGN", "лв."), ("BGN", "лв.", "лв", "лева")),
}
PERIODS = (
    ("hour", r"per hour|an hour|/\s?h(?:ou)?r?\b|hourly|pro stunde|de l'heure|all'ora|na godzinę|za hodinu|i timmen|per uur|/\s?godz"),
    ("day", r"per day|daily|a day|pro tag|par jour|al giorno|/\s?day"), ("week", r"per week|weekly|a week|pro woche|par semaine|/\s?week"),
    ("month", r"per month|/\s?mo(?:nth)?\b|monthly|a month|monatlich|pro monat|im monat|par mois|mensuel|al mese|mensili|miesięcznie|/\s?mies|měsíčně|i månaden|månedlig|havonta|hó(?:nap)?\b|pe lună|lunar|на месец|per maand"),
    ("year", r"per year|/\s?y(?:ea)?r?\b|yearly|annual|annum|a year|jährlich|pro jahr|im jahr|par an|brut annuel|all'anno|rocznie|ročně|om året|årlig|évente|pe an|годишно|per jaar"),
)
_PERIODS = [(u, re.compile(p, re.I)) for u, p in PERIODS]
_NUM = r"(\d{1,3}(?:[,.' \u00a0\u202f]\d{3})+(?:[.,]\d{1,2})?(?!\d)|\d{1,7}(?:[.,]\d{1,2})?(?!\d))\s?([kK]\b)?"
_TO = r"\s*(?:-|–|—|to|bis|à|a|do|till|til)\s*"
_LOCATED = re.compile(r"\b[A-Z]{2,3},\s*[A-Z]{0,2},?\s*[\w .'-]*?\s*-\s*" + _NUM + r"\s*-\s*" + _NUM + r"\s+(USD|CAD|EUR|GBP|CHF)\s+(annually|hourly)", re.I)
_BARE = re.compile(r"(?<![\w$€£.,])" + _NUM + _TO + _NUM + r"\s*\(?(USD|CAD|AUD|EUR|GBP|CHF)\b", re.I)
_DOLLAR = re.compile(r"(?:^|(?<=[\s(\[:;,]))(A|AU|NZ|S|HK|R|MX|US|U|CDN|CA|C)?\$\s?" + _NUM + r"(?:" + _TO + r"(?:[A-Z]{0,3}\$)?\s?" + _NUM + r")?(?:\s*[(\[]?(AUD|NZD|SGD|HKD|BRL|MXN|CAD|USD)\b)?")
_CODED = re.compile(r"\b(USD|AUD|NZD|SGD|HKD|BRL|MXN|CAD)\s?\$?" + _NUM + r"(?:" + _TO + r"(?:USD|AUD|NZD|SGD|HKD|BRL|MXN|CAD)?\s?\$?" + _NUM + r")?")


def _marked(front: tuple[str, ...], behind: tuple[str, ...]) -> tuple[re.Pattern, re.Pattern]:
    f, b = ("(?:" + "|".join(re.escape(x) for x in xs) + ")" for xs in (front, behind))
    return re.compile(rf"(?<!\w){f}\s*{_NUM}(?:{_TO}(?:{f})?\s*{_NUM})?", re.I), re.compile(rf"(?<![\w.,]){_NUM}(?:\s*{b})?(?:{_TO}{_NUM})?\s*{b}(?!\w)", re.I)


_MARKED = [(code, rx) for code, marks in MARKS.items() for rx in _marked(*marks)]
_BAD = re.compile(r"(revenue|funding|raised|budget|bonus of|sign-on|401|valuation|sales of|umsatz|turnover|investment|series [a-e]\b|chiffre d'affaires|fatturato)[^.]{0,30}$", re.I)


def _amount(digits: str, k: str | None) -> float:
    """A number with thousands by point, comma, apostrophe or space; one or two digits behind the last mark are decimals."""
    m = re.fullmatch(r"(.*?)(?:[.,](\d{1,2}))?", digits)
    return float(re.sub(r"\D", "", m.group(1)) + "." + (m.group(2) or "0")) * (1000 if k else 1)


def _found(t: str):
    """(start, end, low, low k, high, high k, currency, unit or None) of all amounts, family by family."""
    for m in _LOCATED.finditer(t):
        yield m.start(), m.end(), *m.groups()[:4], m.group(5).upper(), "year" if m.group(6).lower() == "annually" else "hour"
    for m in _BARE.finditer(t):
        yield m.start(), m.end(), *m.groups()[:4], m.group(5).upper(), None
    for m in _DOLLAR.finditer(t):
        yield m.start(), m.end(), *m.groups()[1:5], DOLLARS.get(m.group(1) or "") or m.group(6) or "USD", None
    for m in _CODED.finditer(t):
        yield m.start(), m.end(), *m.groups()[1:5], m.group(1), None
    for code, rx in _MARKED:
        for m in rx.finditer(t):
            yield m.start(), m.end(), *m.groups(), code, None


@pandas_udf(T.StructType().add("min", "double").add("max", "double").add("currency", "string").add("unit", "string"))
def pay_in_text(text: pd.Series) -> pd.DataFrame:
    """First plausible amount of a text, ranges before single amounts. Families in order: behind a place, bare ranges with
    a code, dollars of eight countries, euro, pound, franc, and seven further European currencies, each with the mark before
    or after. Amounts after words of company finance do not count; an amount without a period is annual and at least 1000."""

    def one(t: str | None):
        best = None
        for start, end, low, k1, high, k2, code, unit in _found(t or ""):
            if _BAD.search(t[max(0, start - 60) : start]):
                continue
            lo = _amount(low, k1 or (k2 if high else None))
            hi = _amount(high, k2) if high else lo
            near = t[end : end + 30]
            unit = unit or min(((m.start(), u) for u, rx in _PERIODS if (m := rx.search(near))), default=(0, "year"))[1]
            if (unit == "year" and hi < 1000) or hi <= 0:
                continue
            row = (min(lo, hi), max(lo, hi), code, unit)
            if high:
                return row
            best = best or row
        return best or (None, None, None, None)

    return pd.DataFrame([one(t) for t in text], columns=["min", "max", "currency", "unit"])


_PLACE = T.StructType().add("country", "string").add("city", "string").add("region", "string").add("mode", "string")
_REGIONS = ("emea", "apac", "latam", "europe", "worldwide")


def _place(text: str | None, cities: dict[str, tuple[str, int]], countries: dict[str, str], states: dict[str, str]) -> tuple[str | None, ...]:
    """(country, city, region, mode) of a place text. Strips remote, hybrid and on-site notes; tries country names, ', XX'
    state or country codes, then city names by population."""
    low = (text or "").lower()
    mode = "hybrid" if "hybrid" in low else "remote" if "remote" in low else "onsite" if re.search(r"on-?site", low) else None
    rest = re.sub(r"\b(remote|hybrid|on-?site)\b|[()]", " ", low)
    parts = [p.strip(" -") for p in re.split(r"[,;/|]| - ", rest) if p.strip(" -")]
    region = next((r.upper() for r in _REGIONS if r in parts), None)
    country = city = None
    for p in reversed(parts):
        country = country or countries.get(p) or states.get(p)
    for p in parts:
        if p in cities and (country is None or cities[p][0] == country):
            city, country = p.title(), country or cities[p][0]
            break
    if city is None and country and len(parts) > 1 and parts[0] not in countries:
        city = parts[0].title()
    return country, city, region, mode


def place_resolver(cities: dict[str, tuple[str, int]], countries: dict[str, str], states: dict[str, str]):
    """UDF of place texts -> (country, city, region, mode). Tables are of bounded size and given by the caller."""

    @pandas_udf(_PLACE)
    def resolve(raw: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_place(t, cities, countries, states) for t in raw], columns=_PLACE.names)

    return resolve


#: Distinct place texts that stand as Python objects at once.
TEXTS_AT_ONCE = 50_000


def places_resolver(cities: dict[str, tuple[str, int]], countries: dict[str, str], states: dict[str, str]):
    """As place_resolver, of lists of place texts, however long; each text is resolved once a batch."""
    names = _PLACE.names

    def resolved(texts: pa.Array) -> pa.Array:
        rows = [_place(t, cities, countries, states) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(len(names))], names=names)

    @F.arrow_udf(T.ArrayType(_PLACE))
    def resolve(lists: pa.Array) -> pa.Array:
        known = lists.flatten().dictionary_encode(null_encoding="encode")
        distinct = [known.dictionary.slice(i, TEXTS_AT_ONCE) for i in range(0, max(1, len(known.dictionary)), TEXTS_AT_ONCE)]
        places = pa.concat_arrays([resolved(x) for x in distinct]).take(known.indices)
        ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int32()))
        return pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int32()), ends]), places)

    return resolve


class _Blocks(HTMLParser):
    """Visible blocks (tag, text) of a page; script and style subtrees are left out."""

    BLOCKS = {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "blockquote", "pre", "div", "article", "section"}
    HIDDEN = {"script", "style", "head", "template"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self.tag, self.text, self.hidden = "body", [], 0

    def flush(self) -> None:
        t = " ".join("".join(self.text).split())
        if t:
            self.found.append((self.tag, t))
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag in self.HIDDEN:
            self.hidden += 1
        elif tag in self.BLOCKS:
            self.flush()
            self.tag = tag

    def handle_endtag(self, tag):
        if tag in self.HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag in self.BLOCKS:
            self.flush()
            self.tag = "body"

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)


def _blocks(html: str | None) -> list[tuple[str, str]]:
    p = _Blocks()
    p.feed(html or "")
    p.flush()
    return p.found


@pandas_udf(T.ArrayType(T.StructType().add("tag", "string").add("text", "string")))
def page_blocks(html: pd.Series) -> pd.Series:
    return html.map(lambda h: [{"tag": t, "text": x} for t, x in _blocks(h)])


@pandas_udf(T.StringType())
def normal_html(html: pd.Series) -> pd.Series:
    """Headings as h2, paragraphs and list items without attributes, all else unwrapped."""
    return html.map(lambda h: _normal(_blocks(h)))


def _normal(blocks: Iterable[tuple[str, str]]) -> str:
    from html import escape

    shape = lambda t: "h2" if re.fullmatch("h[1-6]", t) else "li" if t == "li" else "p"
    return "".join(f"<{shape(t)}>{escape(x, quote=False)}</{shape(t)}>" for t, x in blocks)


#: Pages that a task holds as blocks at a time.
PAGES_AT_ONCE = 128


def with_page_blocks(df: DataFrame, html: str = "html") -> DataFrame:
    """Adds blocks and normal, as page_blocks and normal_html give them. A page is parsed once, and few pages at a time
    are held as blocks, whatever the size of the batches that Spark sends."""
    kind = T.StructType().add("tag", "string").add("text", "string")
    schema = T.StructType([*df.schema.fields, T.StructField("blocks", T.ArrayType(kind)), T.StructField("normal", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.list_(pa.struct([("tag", pa.string()), ("text", pa.string())]))
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(start, PAGES_AT_ONCE)
                found = [list(_blocks(h)) for h in part.column(html).to_pylist()]
                blocks = pa.array([[{"tag": t, "text": x} for t, x in f] for f in found], arrow)
                yield pa.RecordBatch.from_arrays([*part.columns, blocks, pa.array([_normal(f) for f in found], pa.string())], names=[*part.schema.names, "blocks", "normal"])

    return df.mapInArrow(run, schema)


@udtf(returnType=T.StructType().add("block_no", "integer").add("tag", "string").add("text", "string"))
class BlocksOf:
    """Table function: LATERAL blocks_of(html)."""

    def eval(self, html: str):
        for i, (t, x) in enumerate(_blocks(html)):
            yield i, t, x


def coverage(normalised, raw):
    """Length of the normalised text over the raw text's."""
    return F.try_divide(F.length(normalised), F.length(raw))
