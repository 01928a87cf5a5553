"""A provider for tests: vectors that are easy to compute by hand."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from semstore.errors import EmbeddingError
from semstore.operators.embed import ColumnProvider


class WaveProvider(ColumnProvider):
    """A reproducible vector from the characters of a text: ``sin((unit[i mod length] + i) * 0.1)``."""

    sound = True

    def __init__(self, dim: int = 384) -> None:
        if dim < 1:
            raise EmbeddingError("dimensions must be a positive number")
        self.dim = dim

    def column(self, text: Column) -> Column:
        # Element i looks at unit i, or wraps around in a shorter text, so the first ``dim`` characters are enough.
        points = F.transform(F.split(F.substring(text, 1, self.dim), ""), F.ascii)
        # A one-element array hands the units to the elements, so that they are computed once per text.
        steps = F.sequence(F.lit(0), F.lit(self.dim - 1))
        wave = lambda units, i: F.sin((F.element_at(units, i % F.size(units) + 1) + i) * 0.1)
        made = F.transform(F.array(_utf16_units(points)), lambda units: F.transform(steps, lambda i: wave(units, i)))
        return F.element_at(made, 1)


def _utf16_units(points: Column) -> Column:
    """Code points as UTF-16 units: those beyond 65,535 take two."""
    pair = lambda c: F.array(
        (F.lit(0xD800) + F.shiftright(c - 0x10000, 10)).cast("int"), (F.lit(0xDC00) + (c - 0x10000) % 1024).cast("int")
    )
    split = F.flatten(F.transform(points, lambda c: F.when(c > 0xFFFF, pair(c)).otherwise(F.array(c))))
    return F.when(F.exists(points, lambda c: c > 0xFFFF), split).otherwise(points)
