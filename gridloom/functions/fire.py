"""Fire tiles: label rule and the named input features of a pixel."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.temporal import DEGREES_PER_TURN, SECONDS_PER_DAY, cyclic_sin, hhmm_seconds
from gridloom.session import clean

# Channel name -> band number, in feature order.
CHANNELS = {
    "seviri_vis06_": 1,
    "seviri_vis08_": 2,
    "seviri_nir16_": 3,
    "seviri_ir39_": 4,
    "seviri_wv62_": 5,
    "seviri_wv73_": 6,
    "seviri_ir87_": 7,
    "seviri_ir97_": 8,
    "seviri_ir108_": 9,
    "seviri_ir12_": 10,
    "seviri_ir134_": 11,
}
# Bands that are also offered standardised per tile.
TILE_SCORES = {
    "zscore-seviri_vis06": 1,
    "zscore-seviri_nir16": 3,
    "zscore-seviri_ir39": 4,
    "zscore-seviri_ir108": 9,
    "zscore-seviri_ir12": 10,
}
# Label codes, band scales.
LABEL_NODATA, LABEL_FIRE_ABOVE, LABEL_STRICT_MAX = 32767, 7, 9
CHANNEL_SCALE, HRV_SCALE, ZERO_DENOMINATOR = 1000.0, 255.0, 0.001
# Missing code of each static layer (None where missing is NaN), its shift and its scale.
STATIC_CODES = {
    "elevation": -9999, "slope": None, "aspect": -32768, "tpi": -99999, "fuel": None, "cover": -32768, "height": 3.4e38,
}
STATIC_SHIFTS = {"tpi": 18.0}
STATIC_SCALES = {"elevation": 2977.0, "slope": 40.0, "tpi": 32.0, "fuel": 10.0, "cover": 1.0, "height": 33.0}


def fire_label(v: Column, strict: bool = False) -> Column:
    """1 for confident fire codes, else 0. ``strict`` also rejects codes above 9."""
    v = clean(v)
    fire = (v > LABEL_FIRE_ABOVE) & (v != LABEL_NODATA)
    if strict:
        fire = fire & (v <= LABEL_STRICT_MAX)
    return F.when(fire, 1).otherwise(0)


def channel(raw: Column) -> Column:
    return raw / F.lit(CHANNEL_SCALE)


def band_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio of two raw bands; a zero denominator counts as 0.001 after scaling."""
    below = channel(denominator)
    return channel(numerator) / F.when(below == 0, F.lit(ZERO_DENOMINATOR)).otherwise(below)


def band_difference(a: Column, b: Column) -> Column:
    return channel(a) - channel(b)


def static_feature(name: str, raw: Column) -> Column:
    """Scaled static layer; missing codes become 0 before shifting and scaling. Aspect is a sine."""
    code = STATIC_CODES[name]
    if code is None:
        absent = clean(raw).isNull()
    else:  # codes are compared in the layers' own single precision
        absent = raw.cast("float") == F.lit(code).cast("float")
    value = F.when(absent, F.lit(0.0)).otherwise(raw)
    if name == "aspect":
        return cyclic_sin(value, DEGREES_PER_TURN)
    return (value + F.lit(STATIC_SHIFTS.get(name, 0.0))) / F.lit(STATIC_SCALES[name])


def time_feature(label_file: Column) -> Column:
    """Sine of the time of day in the third ``.`` token of the label file's name."""
    stamp = F.try_element_at(F.split(F.substring_index(label_file, "/", -1), "\\."), F.lit(3))
    return cyclic_sin(hhmm_seconds(stamp), SECONDS_PER_DAY)


def feature_builders(band: str = "b") -> dict[str, Column]:
    """All per-pixel features in model order, over columns b1..b11, hrv, label_file and the static layers.

    The per-tile scores are read from columns of their own name, which ``tile_zscore`` makes.
    """
    def b(i: int) -> Column:
        return F.col(f"{band}{i}")

    built = {name: channel(b(i)) for name, i in CHANNELS.items()}
    built["seviri_hrv"] = F.col("hrv") / F.lit(HRV_SCALE)
    built["seviri_ir39/seviri_nir16"] = band_ratio(b(4), b(3))
    built["seviri_ir108/seviri_ir39"] = band_ratio(b(9), b(4))
    built["seviri_ir39-seviri_ir108"] = band_difference(b(4), b(9))
    built.update({name: F.col(f"`{name}`") for name in TILE_SCORES})
    built["time"] = time_feature(F.col("label_file"))
    for layer in STATIC_CODES:
        built[layer] = static_feature(layer, F.col(layer))
    return built


def enabled_features(flags: Mapping[str, int] | Iterable[str]) -> list[str]:
    """Names switched on, in model order whatever the order of the argument."""
    on = {k for k, flag in flags.items() if flag == 1} if isinstance(flags, Mapping) else set(flags)
    return [name for name in feature_builders() if name in on]


def band_feature(name: str, band: str = "b") -> Column:
    return feature_builders(band)[name].alias(name)
