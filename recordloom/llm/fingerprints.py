"""Document fingerprints: of all shingle hashes, those below a fixed fraction of the hash range.

Whether a hash is kept depends on it alone, so fingerprints of texts of any size can be
merged, and what two have in common estimates what the texts have in common even if one is
a thousand times longer. Built-in functions only.

The error of such an estimate falls with the number of hashes kept: about one in eight shingles.
A text of a few words may have none; nothing can be said of it then.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRACTION = 1 / 8
WIDTH = 5
_SPACE = r"[\x20\x09-\x0D]+"


def with_fingerprint(
    rows: DataFrame, name: str, text: Column, fraction: float = FRACTION, width: int = WIDTH
) -> DataFrame:
    """``rows`` with the fingerprint of ``text`` as a sorted array of longs; it replaces a column of that name.

    Shingles are runs of ``width`` words in lower case, cut at ASCII white space; fewer words
    are one shingle. Texts without words, and null, have an empty fingerprint. A text is
    hashed whole, whatever its length. Other columns stay as they are, whatever their names.
    """
    hashes = f"words_{uuid.uuid4().hex}"
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPACE), lambda w: w != "")
    count = F.size(hashes)
    runs = F.transform(
        F.slice(hashes, F.lit(1), F.greatest(count - (width - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *(F.get(hashes, i + k) for k in range(1, width))))
    shingles = F.when(count >= width, runs).when(count > 0, F.array(F.xxhash64(F.array_join(hashes, " ")))).otherwise(
        F.array().cast("array<long>"))
    limit = int(-(2**63) + 2**64 * fraction) if fraction < 1 else 2**63 - 1
    # Hashes of words first, so that a run of words is a hash of a few numbers.
    hashed = rows.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    return hashed.withColumn(name, F.array_sort(F.array_distinct(F.filter(shingles, lambda s: s <= limit)))).drop(hashes)


def merged(first: Column, second: Column) -> Column:
    """The fingerprint of two texts taken together (but for shingles across their border)."""
    return F.array_sort(F.array_union(first, second))


def containment(first: Column, second: Column) -> Column:
    """Estimated part of the first text's shingles that the second has; 0 if the first has no hash."""
    return F.coalesce(F.size(F.array_intersect(first, second)) / F.nullif(F.size(first), F.lit(0)), F.lit(0.0))


def likeness(first: Column, second: Column) -> Column:
    """Containment of the smaller fingerprint in the larger, 0 to 1; 0 where one has no hash."""
    least = F.nullif(F.least(F.size(first), F.size(second)), F.lit(0))
    return F.coalesce(F.size(F.array_intersect(first, second)) / least, F.lit(0.0))


def as_string(fingerprint: Column) -> Column:
    """16 lowercase hexadecimal digits for each hash."""
    return F.array_join(F.transform(fingerprint, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")
