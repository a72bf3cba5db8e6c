"""CL1 contact cleansing, DN1 deny lists, PI1 personal-data shapes.

All rules are built-in regex/string column expressions (JVM side). The
reference database treats '' as NULL, so every cleaned field passes through
``blank_to_null`` before its default is applied.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's rules) -----------------------
# Words removed from names and address lines.
NAME_JUNK = r"(?i)\*|[0-9]|do not|delete|decease|service|wrong|moved|dead"
ADDRESS_JUNK = r"(?i)do not|delete|decease|service|wrong|moved|dead"
# Characters removed from names after the words.
NAME_CHARS = r"\p{Cntrl}|\^|\*|\)|\(|:|\+"
CONTROL = r"\p{Cntrl}+"
# A title is kept only if it holds letters, spaces, '|' and '.'.
TITLE_BAD = r"[^A-Za-z |.]|\\"
EMAIL_OK = r"(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,4}$"
NONE_GIVEN = "None Given"

FIRST_NAME_EXACT = ["OTC", "OVER THE COUNTER", "NEW", "NEW CLIENT", "TEST", "NONE GIVEN"]
LAST_NAME_EXACT = ["OTC", "OVER THE COUNTER", "CLIENT", "NEW CLIENT", "TEST CLIENT", "NONE GIVEN"]
NAME_INFIX = ["*", "CLINIC", "VETERINARY", "HOSPITAL", " VET ", "ANIMAL", " VC ", " VH ", " AC ", " AH "]
ADDRESS1_EXACT = ["OTC", "OVER THE COUNTER", "RETURNED", " ", "NONE GIVEN"]
ADDRESS2_EXACT = [
    "OTC", "OVER THE COUNTER", "CREDIT", "GRANDFATHER", "NO MAIL", "ACCOUNT", "DAD", "INACTIVE",
    "PARENTS", "ALLERGIC", "DAUGHTER", "INCORRECT", "REFUSE", "BAD", "DEBT", "INSUFFIENT", "REMINDER",
    "BANKRUPTCY", "DISCONNECTED", "INVALID", "RETURNED", "BILLING", "DISCOUNT", "INVENTORY", "SEND",
    "BROTHER", "DON'T", "INVOICE", "SISTER", "CASH", "EMERGENCY", "LAND LINE", "TEMPORARY", "CELL",
    "EMPLOYEE", "MAIL", "UNABLE", "CHANGE", "FATHER", "MESSAGE", "UNDELIVERABLE", "CHECK", "FAX", "MOM",
    "UPDATE", "COLLECTIONS", "FILE", "MOTHER", "VERIFY", "CONFIRM", "FORWARD", "NEED", "WIFE",
    "HUSBAND", "DISCARDED",
]
ADDRESS2_INFIX = ["!", "*"]
# Regions outside the mailing area: 13 Canadian provinces and Puerto Rico.
REGION_PREFIXES = ["AB", "BC", "MB", "NB", "NL", "NT", "NS", "NU", "ON", "PE", "QC", "SK", "YT", "PR"]


def blank_to_null(c: Column) -> Column:
    """'' -> NULL (the reference database's string semantics)."""
    return F.when(c == "", F.lit(None).cast("string")).otherwise(c)


def _strip(c: Column, pattern: str) -> Column:
    return blank_to_null(F.regexp_replace(c, pattern, ""))


def clean_name(c: Column) -> Column:
    return F.coalesce(_strip(_strip(c, NAME_JUNK), NAME_CHARS), F.lit(NONE_GIVEN))


def clean_title(c: Column) -> Column:
    c = blank_to_null(c)
    return F.when(c.rlike(TITLE_BAD), F.lit(None).cast("string")).otherwise(c)


def clean_address(c: Column, default: str | None = None) -> Column:
    out = _strip(_strip(c, ADDRESS_JUNK), CONTROL)
    return F.coalesce(out, F.lit(default)) if default is not None else out


def clean_control(c: Column) -> Column:
    return _strip(c, CONTROL)


def clean_zip(c: Column) -> Column:
    """Digits only, first nine, left-padded with blanks to 30 characters."""
    digits = F.when(c.rlike("[^0-9]"), blank_to_null(F.regexp_replace(c, "[^0-9]", ""))).otherwise(c)
    return clean_control(F.lpad(F.substring(digits, 1, 9), 30, " "))


def clean_phone(c: Column) -> Column:
    digits = F.when(c.rlike("[^0-9]"), blank_to_null(F.regexp_replace(c, "[^0-9]", ""))).otherwise(c)
    return clean_control(F.substring(digits, 1, 10))


def valid_email(c: Column) -> Column:
    return F.when(c.rlike(EMAIL_OK), c)


def _alternation(values) -> str:
    import re

    return "|".join(re.escape(v) for v in values)


def _isin(c: Column, values) -> Column:
    """Exact match against a word list as one compiled regex (a long
    isin/OR chain can push whole-stage codegen past the 64 KB limit)."""
    return F.upper(c).rlike("^(?:" + _alternation(values) + ")$")


def _contains_any(c: Column, parts) -> Column:
    return F.upper(c).rlike("(?:" + _alternation(parts) + ")")


# The last-dose extract denies a few more placeholder names.
EXTRA_PLACEHOLDERS = ["PAPERCHART", "TNC CLIENT", "EMPLOYEE", "NM", "SEE ALERT", "PAY AS GOES"]
EXTRA_ADDRESS2 = ["BROTHERS"]


def denied_client(first: Column, last: Column, addr1: Column, addr2: Column, extended: bool = False) -> Column:
    """DN1: true when the client is a placeholder, an institution or carries
    a do-not-contact note. NULL comparisons count as 'not denied'.
    ``extended`` adds the last-dose extract's extra placeholders."""
    more = EXTRA_PLACEHOLDERS if extended else []
    cond = (
        _isin(first, FIRST_NAME_EXACT) | _contains_any(first, NAME_INFIX)
        | _isin(last, LAST_NAME_EXACT + more) | _contains_any(last, NAME_INFIX)
        | _isin(addr1, ADDRESS1_EXACT + more) | F.upper(addr1).contains("*")
        | _isin(addr2, ADDRESS2_EXACT + (EXTRA_ADDRESS2 if extended else [])) | _contains_any(addr2, ADDRESS2_INFIX)
        | ((F.upper(first) == "CASH") & F.upper(last).isin("CLIENT", "CASH"))
    )
    return F.coalesce(cond, F.lit(False))


def excluded_region(state: Column) -> Column:
    """State code starts with an excluded prefix; NULL state is kept."""
    pattern = "^(" + "|".join(REGION_PREFIXES) + ")"
    return F.coalesce(F.upper(state).rlike(pattern), F.lit(False))


# --- PI1 personal-data shapes in free text --------------------------------
PHONE_SHAPE = r"\(?\b[0-9]{3}\)?[-. ]?[0-9]{3}[-. ][0-9]{4}\b"
CARD_SHAPE = r"\b[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}\b"
DIGIT_RUN = r"[0-9]{10,}"


def has_phone(text: Column) -> Column:
    return F.coalesce(text.rlike(PHONE_SHAPE), F.lit(False))


def has_card(text: Column) -> Column:
    return F.coalesce(text.rlike(CARD_SHAPE), F.lit(False))


def has_digit_run(text: Column) -> Column:
    return F.coalesce(text.rlike(DIGIT_RUN), F.lit(False))
