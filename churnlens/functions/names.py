"""Column names from free text."""

from __future__ import annotations

import re

# A run of capitals that no lower-case letter follows, a word with or without
# a leading capital, or a lone capital.
_WORDS = re.compile(r"[A-Z]{2,}(?![a-z])|[A-Z]?[a-z0-9]+|[A-Z]")


def snake_name(text: object) -> str:
    """The words of a header or value in lower case, joined by one underscore.

    Words end at a change of case, and at anything but ASCII letters and
    digits: ``customerID`` and ``Customer (ID)`` both give ``customer_id``,
    ``Bank transfer (automatic)`` gives ``bank_transfer_automatic``.
    """
    return "_".join(w.lower() for w in _WORDS.findall(str(text)))
