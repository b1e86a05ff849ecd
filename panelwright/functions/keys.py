"""Keys that come out the same on every run."""

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: length of a configuration fingerprint.
CONFIG_FINGERPRINT_LENGTH = 8


def config_fingerprint(payload: dict) -> str:
    """Fingerprint of one source configuration, as it appears in landed file names.

    The hashed text is a fixed format: key-sorted JSON with two-space indent.
    """
    text = json.dumps(payload, indent=2, sort_keys=True)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()[:CONFIG_FINGERPRINT_LENGTH]


def row_fingerprint(*columns: str, length: int = 64) -> Column:
    """Fingerprint of row content; the order of the arguments does not matter.

    The full 64 digits are the default: eight digits collide after some ten
    thousand rows, which is fine for configurations and wrong for records.
    """
    text = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return F.substring(F.sha2(text, 256), 1, length)


def surrogate_key(*columns: str) -> Column:
    """64-bit key computed from the natural key, hence stable across runs."""
    return F.xxhash64(*columns)
