"""A bitmap of key hashes that thins out a large table before it is shuffled to a join.

Each key sets a few bits of one 4 KiB block, which its hash chooses. The blocks are built where the keys are, added up
block by block, and sent to every task of the large table: a stored row goes on only if all of its key's bits are set.
A row with a wanted key always does; of the others, a share that follows from the bits per key does too, so the join
that follows stays what decides. The bitmap's size is known before it is built, whatever the number of keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import exp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DataType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType, StructType,
    TimestampNTZType, TimestampType,
)

#: Bits of a block, as the bitmap functions have it.
BLOCK_BITS = 8 * 4096
#: The bitmap's size at most, 64 MiB.
MOST_BITS = 1 << 29
BITS_PER_KEY = 16
PROBES = 4
#: With more unwanted rows than this getting through, the bitmap is not worth its price.
WORTH = 0.25
# Types whose equal values always have equal hashes (doubles do not: -0.0 equals 0.0).
_HASHED = (
    BooleanType, ByteType, ShortType, IntegerType, LongType, DateType, DecimalType, TimestampType, TimestampNTZType,
)


@dataclass(frozen=True)
class KeyBitmap:
    blocks: int

    @property
    def bits(self) -> int:
        return self.blocks * BLOCK_BITS

    def false_share(self, keys: int) -> float:
        """The share of rows with other keys that get through, for that many different keys."""
        return (1 - exp(-PROBES * keys / self.bits)) ** PROBES

    def _places(self, key: Sequence[str], types: StructType) -> tuple[Column, list[Column]]:
        """(block, bits of the block) of a row's key, taken in the given types."""
        names = [F.col(f"`{c}`").cast(types[c].dataType) for c in key]
        block = F.pmod(F.xxhash64(*names), F.lit(self.blocks)).cast("int")
        # Other hashes than the one that chose the block.
        probes = F.xxhash64(F.lit(self.blocks), *names)
        width = BLOCK_BITS.bit_length() - 1
        return block, [F.shiftrightunsigned(probes, width * i).bitwiseAND(BLOCK_BITS - 1) for i in range(PROBES)]

    def build(self, keys: DataFrame, key: Sequence[str], types: StructType) -> DataFrame:
        """Rows (_block, _words): the bits of a block as 1,024 numbers of 32 bits; one row per block with keys."""
        block, bits = self._places(key, types)
        blocks = (
            keys.select(block.alias("_block"), F.explode(F.array(*bits)).alias("_bit"))
            .groupBy("_block")
            .agg(F.bitmap_construct_agg("_bit").alias("_bits"))
        )

        def word(i: Column) -> Column:
            value = F.conv(F.hex(F.substring("_bits", 4 * i + 1, F.lit(4))), 16, 10).cast("bigint")
            return F.when(value >= 1 << 31, value - (1 << 32)).otherwise(value).cast("int")

        return blocks.select("_block", F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 32 - 1)), word).alias("_words"))

    def thin_out(self, stored: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
        """The rows of ``stored`` that may have one of the ``keys``; all that have are among them."""
        block, bits = self._places(key, stored.schema)
        bitmap = F.broadcast(self.build(keys, key, stored.schema))

        def is_set(bit: Column) -> Column:
            # The first byte of a word is its highest; within a byte the first bit is the lowest.
            in_word = bit.bitwiseAND(31).cast("int")
            place = 24 - F.shiftleft(F.shiftright(in_word, 3), 3) + in_word.bitwiseAND(7)
            return F.getbit(F.get("_words", F.shiftright(bit, 5).cast("int")), place) == 1

        found = [f"_bit{i}" for i in range(PROBES)]
        rows = stored.select("*", block.alias("_block"), *(b.alias(name) for b, name in zip(bits, found, strict=True)))
        hits = rows.join(bitmap, "_block")
        for name in found:
            hits = hits.where(is_set(F.col(name)))
        return hits.select(*(f"`{c}`" for c in stored.columns))


def bitmap_for(keys: int, key_types: Sequence[DataType], most_bits: int = MOST_BITS) -> KeyBitmap | None:
    """A bitmap for at most that many keys; none if too much would get through or a type has no fixed hash."""
    if not all(isinstance(t, _HASHED) or t == StringType() for t in key_types):
        return None
    blocks = min(max(1, -(-keys * BITS_PER_KEY // BLOCK_BITS)), max(1, most_bits // BLOCK_BITS))
    bitmap = KeyBitmap(blocks)
    return bitmap if bitmap.false_share(keys) <= WORTH else None
