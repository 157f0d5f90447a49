"""The package's logger."""

from __future__ import annotations

import logging


def setup_logging(level: str = "INFO") -> logging.Logger:
    """One handler on stderr, whatever the number of calls; an unknown level is INFO."""
    logger = logging.getLogger("papyrine")
    if not logger.handlers:
        out = logging.StreamHandler()
        out.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        logger.addHandler(out)
    known = logging.getLevelNamesMapping()
    logger.setLevel(known.get(level.upper(), logging.INFO))
    return logger
