"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Country aliases and their codes; separators between several countries.
COUNTRY_CODES = {
    "deutschland": "DE", "germany": "DE", "niederlande": "NL", "holland": "NL", "netherlands": "NL", "belgien": "BE", "luxemburg": "LU",
    "frankreich": "FR", "france": "FR", "spanien": "ES", "spain": "ES", "portugal": "PT", "italien": "IT", "italy": "IT", "griechenland": "GR",
    "osterreich": "AT", "schweiz": "CH", "danemark": "DK", "norwegen": "NO", "schweden": "SE", "finnland": "FI", "island": "IS", "irland": "IE",
    "grossbritannien": "GB", "polen": "PL", "tschechien": "CZ", "slowakei": "SK", "ungarn": "HU", "rumanien": "RO", "bulgarien": "BG",
    "kroatien": "HR", "slowenien": "SI", "serbien": "RS", "estland": "EE", "lettland": "LV", "litauen": "LT", "ukraine": "UA", "turkei": "TR",
    "israel": "IL", "agypten": "EG", "marokko": "MA", "tunesien": "TN", "kenia": "KE", "sudafrika": "ZA", "chile": "CL", "peru": "PE",
    "ecuador": "EC", "kolumbien": "CO", "brasilien": "BR", "argentinien": "AR", "uruguay": "UY", "costa rica": "CR", "mexiko": "MX",
    "usa": "US", "kanada": "CA", "indien": "IN", "thailand": "TH", "vietnam": "VN", "indonesien": "ID", "china": "CN", "japan": "JP",
    "australien": "AU", "neuseeland": "NZ",
}
COUNTRY_SEPARATOR = r"\s*[,;/|+&\n]\s*|\s+(?:und|oder|and|or)\s+"
# Words that stand for yes.
YES = ("ja", "yes", "true", "1", "x", "relevant")
# Letters with marks and without.
MARKED, PLAIN = "äöüáàâéèêëíìîóòôúùûñç", "aouaaaeeeeiiiooouuunc"


def casefold(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def key_text(c: Column) -> Column:
    """Lower case with one blank for anything but German letters and digits; '' for null."""
    return F.trim(F.regexp_replace(casefold(F.coalesce(c, F.lit(""))), r"[^a-z0-9äöü]+", " "))


def plain_text(c: Column) -> Column:
    """Casefolded without marks, anything but letters and digits as blanks."""
    return F.trim(F.regexp_replace(F.translate(casefold(c), MARKED, PLAIN), r"[^a-z0-9]+", " "))


def slug(c: Column, default: str = "group") -> Column:
    """Umlauts spelled out, anything else but letters and digits as single underscores."""
    s = casefold(c)
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(s, r"[^a-z0-9]+", "_"), r"^_+|_+$", ""), F.lit("")), F.lit(default))


def title_words(c: Column) -> Column:
    """Every run of letters with its first letter upper and the others lower."""
    parts = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2))))), "")


def title_first(c: Column) -> Column:
    """Every word with its first letter upper, the others as they are."""
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), " ")


def supplier_label(c: Column) -> Column:
    """The supplier contained in a text, by the order of the fixed list; Unknown if none is."""
    s, out = F.lower(c), F.lit("Unknown")
    for name in reversed(("metro", "selgros", "handelshof", "edeka")):
        out = F.when(s.contains(name), F.lit(name.title())).otherwise(out)
    return out


def country_codes(c: Column) -> Column:
    """Codes of the countries a text lists, in order, once each, as 'DE, NL'; a part that is none stays as it stands."""
    pairs = [F.lit(v) for kv in COUNTRY_CODES.items() for v in kv]
    table = F.create_map(*pairs)
    parts = F.filter(F.split(F.coalesce(c, F.lit("")), COUNTRY_SEPARATOR), lambda p: F.trim(p) != "")
    one = lambda p: F.coalesce(F.when(F.trim(p).rlike("^[A-Za-z]{2}$"), F.upper(F.trim(p))), F.try_element_at(table, plain_text(p)), F.trim(p))
    return F.array_join(F.array_distinct(F.transform(parts, one)), ", ")


def labelled_lines(labels: dict[str, Column]) -> Column:
    """'Label: value' lines, without those whose value is null or blank."""
    return F.concat_ws("\n", *[F.when(F.trim(v.cast("string")) != "", F.concat(F.lit(f"{k}: "), v.cast("string"))) for k, v in labels.items()])


def wrapped(c: Column, width: int = 30) -> Column:
    """Greedy line breaks at blanks so that no line passes the width, unless one word does."""
    room = lambda a, w: F.length(F.substring_index(a, "\n", -1)) + 1 + F.length(w) <= width
    return F.aggregate(F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), " "), F.lit(""), lambda a, w: F.when(a == "", w).when(room(a, w), F.concat(a, F.lit(" "), w)).otherwise(F.concat(a, F.lit("\n"), w)))


def url_host(c: Column) -> Column:
    """Host of a url in lower case without 'www.'; null if there is none."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(c)), r"^[a-z][a-z0-9+.-]*://(?:www\.)?([^/:?#]+)", 1), F.lit(""))


def url_key(c: Column) -> Column:
    """A url without query, fragment and closing slash, in lower case: equal for one page."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[?#].*$", ""), r"/+$", "")


def file_parts(c: Column) -> Column:
    """struct(supplier, year, series, number) of a path such as data/metro/2024/gastro_0000011.pdf; nulls where it differs."""
    pattern = r"^data/([^/]+)/(\d{4})/(?:.*/)?(.+)_(\d+)\.pdf$"
    part = lambda i: F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))
    return F.struct(part(1).alias("supplier"), part(2).cast("int").alias("year"), part(3).alias("series"), part(4).cast("bigint").alias("number"))


def stable_id(*parts: Column, prefix: str = "p_", size: int = 16) -> Column:
    """A prefix and the first hex digits of the SHA-1 of the parts joined by '||'; null parts as ''."""
    return F.concat(F.lit(prefix), F.left(F.sha1(F.concat_ws("||", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), F.lit(size)))


def is_yes(c: Column) -> Column:
    return F.coalesce(casefold(F.trim(c)).isin(*YES), F.lit(False))


def contains_all(text: Column, wanted: str) -> Column:
    """Whether a text holds the wanted one, whatever its case."""
    return F.lower(text).contains(wanted.lower())




# Labels of the category codes, in the order in which they are shown.
CATEGORIES = {"fisch": "Fisch", "fleisch": "Fleisch", "gefluegel": "Geflügel", "obst_gemuese": "Obst & Gemüse", "mopro": "Mopro", "tiefkuehl": "Tiefkühl", "trocken": "Trocken"}
# Padded words that show an English text.
ENGLISH = (" the ", " and ", " of ", " with ", " for ", " is ", " are ")


def category_label(c: Column) -> Column:
    """The label of a category code; any other code as title words."""
    table = F.create_map(*[F.lit(v) for kv in CATEGORIES.items() for v in kv])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(c))), title_words(c))


def category_rank(c: Column) -> Column:
    """The place of a category code in the fixed order from 0, unknown ones behind the last."""
    at = F.array_position(F.lit(list(CATEGORIES)), F.lower(F.trim(c)))
    return F.when(at > 0, at - 1).otherwise(len(CATEGORIES)).cast("int")


def with_brand_line(c: Column, brand: Column, width: int = 30) -> Column:
    """The wrapped text, and below it the brand where there is one."""
    return F.concat_ws("\n", F.nullif(wrapped(c, width), F.lit("")), F.when(F.trim(brand) != "", F.concat(F.lit("Brand: "), F.trim(brand), F.lit(","))))


def offer_cell(price: Column, unit: Column, origin: Column, start: Column, end: Column, source: Column) -> Column:
    """The long cell of an offer: labelled lines of what is known, the source as its file name."""
    known = lambda c: F.when(~F.lower(F.trim(c)).isin("", "unknown", "unbekannt"), F.trim(c))
    return labelled_lines({"Price": price, "Unit": known(unit), "Origin": known(origin), "Valid": F.nullif(F.concat_ws(" - ", start, end), F.lit("")), "Source": F.substring_index(source, "/", -1)})


def verdict(c: Column) -> Column:
    """struct(verdict, reason) of an answer in free text: its first 'ja' or 'nein', and the next two words behind it."""
    pattern = r"(?is)^.*?\b(ja|nein)\b[\s:,.;-]*(.*)$"
    word = F.initcap(F.regexp_extract(c, pattern, 1))
    rest = F.array_join(F.slice(F.split(F.trim(F.regexp_replace(F.regexp_extract(c, pattern, 2), r"\s+", " ")), " "), 1, 2), " ")
    return F.struct(F.nullif(word, F.lit("")).alias("verdict"), F.when(word != "", rest).alias("reason"))


def signal(c: Column) -> Column:
    """The first line of a signal text up to ';', without a bullet; white space squeezed, a leading '=' as '±'."""
    first = F.regexp_extract(F.trim(c), r"^[\s*•-]*([^\n;]*)", 1)
    return F.regexp_replace(F.trim(F.regexp_replace(first, r"\s+", " ")), r"^=", "±")


def looks_english(c: Column) -> Column:
    """Whether a text holds at least two different English marker words."""
    padded = F.concat(F.lit(" "), F.lower(F.regexp_replace(c, r"\s+", " ")), F.lit(" "))
    return F.coalesce(sum([padded.contains(w).cast("int") for w in ENGLISH]) >= 2, F.lit(False))


def card(c: Column) -> Column:
    """struct(title, start, end) of a card's lines: the first line that is neither a date range nor a button, and the two
    dates of 'dd.mm. - dd.mm.yyyy', which share the year."""
    lines = F.transform(F.split(c, "\n"), lambda x: F.trim(x))
    title = F.get(F.filter(lines, lambda x: (x != "") & ~x.rlike(r"^\d{1,2}\.\d{1,2}\.") & ~F.lower(x).isin("aktuell", "vorschau", "jetzt ansehen", "download")), F.lit(0))
    pattern = r"(\d{1,2})\.(\d{1,2})\.\s*-\s*(\d{1,2})\.(\d{1,2})\.(\d{4})"
    part = lambda i: F.regexp_extract(c, pattern, i).try_cast("int")
    day = lambda d, m: F.try_make_timestamp(part(5), part(m), part(d), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    return F.struct(title.alias("title"), day(1, 2).alias("start"), day(3, 4).alias("end"))


def brochure_title(c: Column) -> Column:
    """Lower case without what stands in brackets, marks as blanks, white space squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[(\[][^)\]]*[)\]]", " "), r"[^a-z0-9äöüß]+", " "))
