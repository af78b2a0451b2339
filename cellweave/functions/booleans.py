"""Boolean words in French and English."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words accepted as true and false.
TRUE_WORDS = ("true", "vrai", "oui", "yes", "1", "y", "o")
FALSE_WORDS = ("false", "faux", "non", "no", "0", "n")


def boolean_word(c: Column) -> Column:
    # No word is longer, so whole texts are not lower-cased to find out.
    low = F.lower(F.when(F.length(c) <= 5, c))
    return F.when(low.isin(*TRUE_WORDS), True).when(low.isin(*FALSE_WORDS), False)
