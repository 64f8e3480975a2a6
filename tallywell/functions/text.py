"""Predicates for missing text. All are TRUE or FALSE, never NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space, Unicode included.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)




def empty_sql(column: str) -> str:
    """NULL or the empty string; white space counts as content."""
    return f"coalesce({column}, '') = ''"


def blank_sql(column: str) -> str:
    """NULL, empty, or nothing but white space.

    Text that sorts between '!' and '~' starts with a visible ASCII character, so it is not blank:
    a comparison settles nearly every row, and only the others are trimmed.
    """
    text = f"coalesce({column}, '')"
    return f"({text} NOT BETWEEN '!' AND '~' AND trim(LEADING '{WHITE_SPACE}' FROM {text}) = '')"


def is_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def is_blank(c: Column) -> Column:
    """The test of ``blank_sql`` on any column expression."""
    text = F.coalesce(c, F.lit(""))
    return ~text.between("!", "~") & (F.ltrim(text, F.lit(WHITE_SPACE)) == "")
