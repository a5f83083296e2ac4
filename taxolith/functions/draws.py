"""Draws that counters decide: the same numbers at any partitioning, in columns, arrays and SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the multiplier of the 32-bit mixing steps.
MIX = 0x45D9F3B
WORD = 0xFFFFFFFF


def mixed_array(x):
    """32-bit numbers well mixed into others; any integers below 2^32."""
    import numpy as np

    x = np.asarray(x, dtype=np.uint64)
    for _ in range(2):
        x = (((x >> np.uint64(16)) ^ x) * np.uint64(MIX)) & np.uint64(WORD)
    return (x >> np.uint64(16)) ^ x


def word_array(seed: int, *counters):
    """The 32-bit draws of a seed and counters, numbers or arrays, which broadcast."""
    import numpy as np

    out = mixed_array(seed)
    for c in counters:
        out = mixed_array(out ^ np.asarray(c, dtype=np.uint64))
    return out


def key_array(names):
    """A 32-bit number for each name: the first digits of its MD5."""
    import hashlib

    import numpy as np

    return np.array([int(hashlib.md5(str(n).encode("utf-8", "surrogatepass")).hexdigest()[:8], 16) for n in names], dtype=np.uint64)


def unit(digest: Column, k: int) -> Column:
    """The k-th eight digits of a hexadecimal digest as a number between 0 and 1, both excluded."""
    return (F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("double") + 0.5) / float(WORD + 1)


def bound(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def log_gamma(shape: Column, counter: Column, tries: int = 8) -> Column:
    """Logarithm of a Gamma variate of ``shape`` (one half or more) and scale 1, decided by a text.

    Marsaglia and Tsang's rejection: try k takes three numbers from the MD5 of ``counter:k``;
    the first accepted one counts, and with a chance below 1e-10 that none of ``tries`` is, the
    mode. Shapes below one are raised by one and scaled back by a power of the MD5 of ``counter`` itself.
    """
    raised = F.when(shape < 1, shape + 1).otherwise(shape)
    d = raised - F.lit(1.0) / 3

    def attempt(k: Column) -> Column:
        def of(digest: Column) -> Column:
            def accept(normal: Column) -> Column:
                def cubed(root: Column) -> Column:
                    cube = F.greatest(root * root * root, F.lit(1e-300))
                    fits = (root > 0) & (F.log(unit(digest, 2)) < 0.5 * normal * normal + d - d * cube + d * F.log(cube))
                    return F.when(fits, F.log(d * cube))

                return bound(1 + normal / F.sqrt(9 * d), cubed)

            return bound(F.sqrt(-2 * F.log(unit(digest, 0))) * F.cos(2 * F.pi() * unit(digest, 1)), accept)

        return bound(F.md5(F.concat(counter, F.lit(":"), k.cast("string")).cast("binary")), of)

    # a try is made only where those before it failed
    variate = F.aggregate(F.sequence(F.lit(0), F.lit(tries - 1)), F.lit(None).cast("double"), lambda found, k: F.coalesce(found, attempt(k)))
    boost = F.when(shape < 1, F.log(unit(F.md5(counter.cast("binary")), 0)) / shape).otherwise(F.lit(0.0))
    return F.coalesce(variate, F.log(d)) + boost
