from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything Unicode counts as white space. Spark's plain trim() only knows the ASCII blank.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(col: Column) -> Column:
    """Without leading and trailing white space of any kind.

    Trimming a set of characters costs several times a plain trim, so it runs only on values that
    still begin or end with something other than visible ASCII once their blanks are off.
    """
    bare = F.trim(col)
    visible = (bare >= "!") & (bare < "\x7f") & F.substring(bare, -1, 1).between("!", "~")
    return F.when(visible, bare).otherwise(F.btrim(bare, F.lit(WHITESPACE)))
