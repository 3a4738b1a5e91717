"""Column expressions over reflectance bands. Missing values are NULL inside; -9999 only leaves at a sink."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NODATA = -9999.0
#: Scene classes that hide the ground: no data, defective, cloud shadow, clouds, cirrus, snow.
MASKED_CLASSES = (0, 1, 3, 8, 9, 10, 11)
#: Bands that each index reads.
INDEX_BANDS = {"ndvi": ("b08", "b04"), "ndmi": ("b08", "b11"), "msi": ("b11", "b08"), "bsi": ("b11", "b04", "b08", "b02")}


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalized_difference(a: str | Column, b: str | Column) -> Column:
    """(a - b) / (a + b); NULL where the sum is 0."""
    return F.try_divide(_c(a) - _c(b), _c(a) + _c(b))


def ndvi(nir: str | Column = "b08", red: str | Column = "b04") -> Column:
    return normalized_difference(nir, red)


def ndmi(nir: str | Column = "b08", swir: str | Column = "b11") -> Column:
    return normalized_difference(nir, swir)


def msi(swir: str | Column = "b11", nir: str | Column = "b08") -> Column:
    return F.try_divide(_c(swir), _c(nir))


def bsi(swir: str | Column = "b11", red: str | Column = "b04", nir: str | Column = "b08", blue: str | Column = "b02") -> Column:
    return normalized_difference(_c(swir) + _c(red), _c(nir) + _c(blue))


INDICES = {"ndvi": ndvi, "ndmi": ndmi, "msi": msi, "bsi": bsi}


def required_bands(indices: list[str]) -> list[str]:
    """The distinct bands of several indices, in order of name."""
    unknown = [x for x in indices if x.lower() not in INDEX_BANDS]
    if unknown:
        raise ValueError(f"unknown index: {', '.join(unknown)}")
    return sorted({b for x in indices for b in INDEX_BANDS[x.lower()]})


def missing_to_null(value: str | Column) -> Column:
    v = _c(value)
    return F.when(F.isnan(v) | (v == NODATA), None).otherwise(v)


def null_to_missing(value: str | Column) -> Column:
    return F.coalesce(F.when(F.isnan(_c(value)), None).otherwise(_c(value)), F.lit(NODATA))


def unless_masked(band: str | Column, scl: str | Column = "scl", masked: tuple[int, ...] = MASKED_CLASSES) -> Column:
    """The band, NULL where the scene class is one of the masked ones; an unknown class masks nothing."""
    return F.when(~F.coalesce(_c(scl).isin(*masked), F.lit(False)), _c(band))


def all_valid(*bands: str | Column) -> Column:
    out = F.lit(True)
    for b in bands:
        out = out & _c(b).isNotNull() & ~F.isnan(_c(b))
    return out


def clip01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


# Fixed values of the published true-colour formula.
MAX_REFLECTANCE, MID_REFLECTANCE, SATURATION, GAMMA, GAMMA_OFFSET = 3.0, 0.13, 1.3, 2.3, 0.01
RAYLEIGH = {"r": 0.013, "g": 0.024, "b": 0.041}
SRGB_EXPONENT = 0.41666666666


def _tone(reflectance: Column) -> Column:
    """The tone curve through the middle reflectance, then the gamma curve with offset."""
    x = clip01(reflectance / MAX_REFLECTANCE)
    t = MID_REFLECTANCE / MAX_REFLECTANCE
    curved = F.try_divide(x * (x * t - 1), x * (2 * t - 1) - t)
    low = GAMMA_OFFSET**GAMMA
    return (F.pow(curved + GAMMA_OFFSET, F.lit(GAMMA)) - low) / ((1 + GAMMA_OFFSET) ** GAMMA - low)


def true_color(red: str | Column, green: str | Column, blue: str | Column) -> dict[str, Column]:
    """Display values r, g, b from 0 to 1 of reflectances: haze taken off, tone curve, more saturation, sRGB."""
    tones = {k: _tone(_c(x) - RAYLEIGH[k]) for k, x in zip("rgb", (red, green, blue), strict=True)}
    grey = (tones["r"] + tones["g"] + tones["b"]) / 3.0 * (1 - SATURATION)
    linear = {k: clip01(grey + x * SATURATION) for k, x in tones.items()}
    return {k: F.when(x <= 0.0031308, x * 12.92).otherwise(F.pow(x, F.lit(SRGB_EXPONENT)) * 1.055 - 0.055) for k, x in linear.items()}


def to_byte(x: Column) -> Column:
    """0 to 1 as 0 to 255, halves to the even number."""
    return F.rint(clip01(x) * 255.0).cast("short")
