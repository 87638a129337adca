"""Column groups found by name when the plan is built."""

from __future__ import annotations

import re


def select_names(columns, pattern=None, exact=(), prefixes=(), suffixes=()):
    """Names that match the regex, the exact list, a prefix or a suffix; input order is kept."""
    rx = re.compile(pattern) if pattern else None
    return [
        c for c in columns
        if (rx and rx.search(c)) or c in exact
        or any(c.startswith(p) for p in prefixes) or any(c.endswith(s) for s in suffixes)
    ]


def grid_columns(columns, pattern):
    """Month columns sorted by the number in the name, with that number."""
    found = [(int(re.search(r"[0-9]+", c).group()), c) for c in select_names(columns, pattern)]
    return sorted(found)
