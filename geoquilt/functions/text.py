"""Names, paths, lists and licence texts as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of licences, by key.
LICENSE_ALIASES = {
    "CC0": ("CC0", "CC0_1_0", "PUBLIC_DOMAIN", "PUBLIC_DOMAIN_MARK", "PUBLIC_DOMAIN_DEDICATION"),
    "CC_BY": ("CC_BY", "CC_BY_4_0", "CC_BY_3_0", "CC_BY_2_0"),
    "CC_BY_SA": ("CC_BY_SA", "CC_BY_SA_4_0", "CC_BY_SA_3_0"),
    "CC_BY_ND": ("CC_BY_ND", "CC_BY_ND_4_0"),
    "CC_BY_NC": ("CC_BY_NC", "CC_BY_NC_4_0"),
    "CC_BY_NC_SA": ("CC_BY_NC_SA", "CC_BY_NC_SA_4_0"),
    "CC_BY_NC_ND": ("CC_BY_NC_ND", "CC_BY_NC_ND_4_0"),
    "COMMERCIAL": ("COMMERCIAL", "COMMERCIAL_USE", "ALL_COMMERCIAL"),
}
# Parts of licence addresses, the first that occurs counts.
LICENSE_ADDRESSES = (
    ("creativecommons.org/publicdomain/zero", "CC0"),
    ("creativecommons.org/licenses/by-nc-nd", "CC_BY_NC_ND"),
    ("creativecommons.org/licenses/by-nc-sa", "CC_BY_NC_SA"),
    ("creativecommons.org/licenses/by-nc", "CC_BY_NC"),
    ("creativecommons.org/licenses/by-nd", "CC_BY_ND"),
    ("creativecommons.org/licenses/by-sa", "CC_BY_SA"),
    ("creativecommons.org/licenses/by", "CC_BY"),
)
COMMERCIAL = ("CC0", "CC_BY", "CC_BY_SA", "CC_BY_ND")


def slug(name: Column) -> Column:
    """Lower-case letters and digits, all else one underscore, none at the ends; ``aoi`` if nothing is left."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_")), F.lit("")), F.lit("aoi"))


def output_name(variable: Column, year: Column, season: Column, aoi: Column, extension: Column, timed: Column) -> Column:
    """variable_year_season_aoi.ext, without year and season for what has no time."""
    ext = F.coalesce(F.nullif(F.ltrim(extension, F.lit(".")), F.lit("")), F.lit("tif"))
    stem = F.when(timed, F.concat_ws("_", variable, year, season, aoi)).otherwise(F.concat_ws("_", variable, aoi))
    return F.concat(stem, F.lit("."), ext)


def path_join(*parts: Column) -> Column:
    """The parts that aren't blank, without slashes at their ends, joined by slashes."""
    kept = F.filter(F.array(*[p.cast("string") for p in parts]), lambda x: x.isNotNull() & (F.trim(x) != ""))
    return F.array_join(F.transform(kept, lambda x: F.trim(x, F.lit("/"))), "/")


def list_of(text: Column) -> Column:
    """The parts of a comma-separated list, trimmed, without blank ones."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def numbers_of(text: Column) -> Column:
    """The whole numbers of a comma-separated list; what isn't one is passed over."""
    return F.filter(F.transform(list_of(text), lambda x: x.try_cast("int")), lambda x: x.isNotNull())


def license_code(text: Column) -> Column:
    """One of eight licence codes for free text, an address or a code; NULL if it is none.

    Spellings first, then addresses, then words: a public domain word, or Creative Commons with its
    conditions.
    """
    raw = F.trim(text)
    key = F.trim(F.regexp_replace(F.upper(raw), "[^A-Z0-9]+", "_"), F.lit("_"))
    spellings = F.create_map(*[F.lit(x) for code, names in LICENSE_ALIASES.items() for name in names for x in (name, code)])

    def judged(x: Column) -> Column:
        word = lambda *names: reduce(lambda a, b: a & b, (F.array_contains(x["words"], n) for n in names))
        cc = word("creativecommons") | word("creative", "commons") | word("cc")
        nc, sa = word("nc") | word("noncommercial"), word("sa") | word("sharealike")
        nd = word("nd") | word("noderivatives") | word("no", "derivatives")
        found = F.when(x["raw"].isNull() | (x["raw"] == ""), None).when(x["spelled"].isNotNull(), x["spelled"])
        for part, code in LICENSE_ADDRESSES:
            found = found.when(x["lower"].contains(part), code)
        found = found.when(word("cc0") | word("publicdomain") | word("public", "domain"), "CC0").when(~cc, None)
        found = found.when(nc & sa, "CC_BY_NC_SA").when(nc & nd, "CC_BY_NC_ND").when(nc, "CC_BY_NC").when(sa, "CC_BY_SA").when(nd, "CC_BY_ND")
        return found.when(word("by") | word("attribution"), "CC_BY")

    # What all conditions look at is made once, as the one element of an array.
    parts = F.struct(raw.alias("raw"), F.lower(raw).alias("lower"), F.split(F.lower(raw), "[^a-z0-9]+").alias("words"), F.try_element_at(spellings, F.coalesce(key, F.lit(""))).alias("spelled"))
    return F.transform(F.array(parts), judged)[0]


def license_allowed(text: Column, allowed: list[str]) -> Column:
    """Whether a licence is among the allowed codes; COMMERCIAL stands for all that permit it.

    An empty list allows everything, a list of unknown names is an error.
    """
    known = set(LICENSE_ALIASES)
    if allowed and not known & set(allowed):
        raise ValueError(f"no known licence among {allowed}")
    if not allowed:
        return F.lit(True)
    codes = sorted(set(allowed) & known | (set(COMMERCIAL) if "COMMERCIAL" in allowed else set()))
    return F.coalesce(license_code(text).isin(*codes), F.lit(False))


def first_year(text: Column) -> Column:
    """The first four digits in a row, as a number."""
    return F.nullif(F.regexp_extract(text, "[0-9]{4}", 0), F.lit("")).cast("int")


def depth_name(text: Column) -> Column:
    """A soil depth with its unit: 15-30 and 15-30CM become 15-30cm."""
    lower = F.regexp_replace(F.lower(F.trim(text)), " ", "")
    return F.when(lower.endswith("cm"), lower).otherwise(F.concat(lower, F.lit("cm")))


def statistic_name(text: Column) -> Column:
    """A soil statistic: quantiles with a capital Q, others in lower case, blank is the mean."""
    lower = F.lower(F.trim(text))
    return F.when(F.coalesce(lower, F.lit("")) == "", "mean").when(lower.startswith("q"), F.concat(F.lit("Q"), F.substring(lower, 2, 99))).otherwise(lower)


# Catalogue ids of collections.
COLLECTIONS = {"SENTINEL2_L2A": "sentinel-2-l2a", "SENTINEL2_L2A_SENTINELHUB": "sentinel-2-l2a"}


def catalogue_id(collection: Column) -> Column:
    """The catalogue's id of a satellite collection: its exact name, else its mission and level in any case; NULL if unknown."""
    upper, exact = F.upper(collection), F.create_map(*[F.lit(x) for pair in COLLECTIONS.items() for x in pair])
    level = F.when(upper.contains("L2A"), "sentinel-2-l2a").when(upper.contains("L1C"), "sentinel-2-l1c")
    return F.coalesce(F.try_element_at(exact, collection), F.when(upper.contains("SENTINEL2"), level))


def first_given(*values: Column) -> Column:
    """The first value that is neither NULL nor blank: an argument, then settings, then a constant."""
    return F.coalesce(*[F.when(F.trim(v.cast("string")) != "", v) for v in values])
