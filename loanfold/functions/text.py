"""Text cleansing: blanks, names, addresses, numbers and coordinates kept as text."""

from pyspark.sql import Column, functions as F

# The text forms accepted as a number, and the characters that are noise around one.
DECIMAL_TEXT = r"^-?[0-9]+(\.[0-9]+)?\z"
SIGNED_INTEGER_TEXT = r"^-?[0-9]+\z"
DIGITS_TEXT = r"^[0-9]+\z"
NOT_NUMERIC = r"[^0-9.\-]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c) -> Column:
    return F.trim(_col(c))


def upper_trimmed(c) -> Column:
    return F.upper(F.trim(_col(c)))


def blank_to_null(c) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def join_name(*parts) -> Column:
    """Non-blank parts joined by one space; NULL when every part is blank."""
    return F.nullif(F.concat_ws(" ", *[blank_to_null(p) for p in parts]), F.lit(""))


def join_address(first, *rest) -> Column:
    """Each non-blank part after the first is preceded by ', ', even when the first is blank; never NULL."""
    pieces = [F.coalesce(blank_to_null(first), F.lit(""))]
    for part in rest:
        text = blank_to_null(part)
        pieces.append(F.when(text.isNotNull(), F.concat(F.lit(", "), text)).otherwise(""))
    return F.trim(F.concat(*pieces))


def strip_percent(c) -> Column:
    return F.trim(F.replace(_col(c).cast("string"), F.lit("%"), F.lit("")))


def strip_noise(c) -> Column:
    return F.regexp_replace(_col(c).cast("string"), NOT_NUMERIC, "")


_CLEANERS = {
    "trim": lambda c: F.trim(_col(c).cast("string")),
    "percent": strip_percent,
    "noise": strip_noise,
}


def safe_decimal(c, precision: int, scale: int, strip: str = "trim", whole: bool = False) -> Column:
    """Numeric text as a decimal, NULL when the cleaned text is no number.

    strip: 'trim' keeps the text, 'percent' drops '%', 'noise' drops every non-numeric character.
    whole: accept integers only.
    """
    text = _CLEANERS[strip](c)
    form = SIGNED_INTEGER_TEXT if whole else DECIMAL_TEXT
    return F.when(text.rlike(form), text.try_cast(f"decimal({precision},{scale})"))


def safe_int(c, kind: str = "int") -> Column:
    """Digits-only text as a whole number, else NULL. The guard also keeps failing casts off the hot path."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(DIGITS_TEXT), text.try_cast(kind))


def signed_coordinate(c, negative_letter: str) -> Column:
    """Coordinate text as decimal(20,8), negated when it names the southern or western hemisphere."""
    value = safe_decimal(c, 20, 8, strip="noise")
    sign = F.when(_col(c).ilike(f"%{negative_letter}%"), -1).otherwise(1)
    return (value * sign).cast("decimal(20,8)")


def prefer(condition: Column, primary, fallback) -> Column:
    return F.when(condition, _col(primary)).otherwise(_col(fallback))


def has_address(c) -> Column:
    """A usable address: present and not the text '0'."""
    return _col(c).isNotNull() & (_col(c) != "0")
