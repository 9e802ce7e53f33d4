"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .alignment import op12
from .chat import OP3_SQL, op3
from .fingerprint import op4
from .langid import op1
from .licenses import OP11_SQL, op11
from .mixing import op6
from .packing import op10
from .quality import op2
from .sharding import op8
from .simhash import op9
from .variants import OP13_SQL, op13
from .vptree import OP7_SQL, op7
from .warc import OP5_SQL, op5

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1,
    "op2_quality": op2,
    "op3_chat": op3,
    "op4_fingerprints": op4,
    "op5_warc": op5,
    "op6_mixing": op6,
    "op7_nearest": op7,
    "op8_sharding": op8,
    "op9_simhash": op9,
    "op10_packing": op10,
    "op11_licenses": op11,
    "op12_alignment": op12,
    "op13_variants": op13,
}

ORACLES: dict[str, str] = {
    "op3_chat": OP3_SQL,
    "op5_warc": OP5_SQL,
    "op7_nearest": OP7_SQL,
    "op11_licenses": OP11_SQL,
    "op13_variants": OP13_SQL,
}
