"""Record headers: the standard 20-byte form and the extended 32-byte form.

All headers of a batch are read at once, as :mod:`acctlake.operators.entries` reads fields. As column expressions, a filter on
the type would be moved in front of them and work the type out again for each comparison.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from acctlake.operators.entries import bytes_of, read_field

# The task functions travel with the plan, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the two header forms (positions are 0-based, after the length prefix).
STANDARD_LENGTH, EXTENDED_LENGTH = 20, 32
EXTENDED_MARK = 0xFFFF
STANDARD = {"flags": 2, "type": 3, "time": 4, "date": 8, "system": 12, "subsystem": 16, "subtype": 20}
EXTENDED = {"flags": 8, "type": 2, "time": 10, "date": 14, "system": 18, "subsystem": 22, "subtype": 22}
#: This type keeps its subtype where the subsystem name would be.
SUBTYPE_OVER_SUBSYSTEM = 1154


HEADER_TYPES = {
    "error": "string", "smf_timestamp": "timestamp", "smf_date": "date", "system_id": "string", "subsystem_id": "string",
    "record_type": "int", "subtype": "int", "flags": "smallint",
}


def _headers(bodies: pa.Array, errors: pa.Array) -> list[pa.Array]:
    """The columns of ``HEADER_TYPES`` for a batch of records."""
    data, bounds = bytes_of(bodies)
    begin, end = bounds[:-1], bounds[1:]
    size = end - begin
    missing = bodies.is_null().to_numpy(zero_copy_only=False)

    def number(at, kind: str) -> np.ndarray:
        return read_field(kind, data, begin + at, end, 0, 0).to_numpy()

    extended = number(0, "u16") == EXTENDED_MARK
    at = {name: np.where(extended, EXTENDED[name], STANDARD[name]) for name in STANDARD}
    record_type = np.where(extended, number(EXTENDED["type"], "u16"), number(STANDARD["type"], "u8")).astype(np.int32)
    # Without a body there are no names.
    names = {
        name: pc.if_else(pa.array(missing), pa.scalar(None, pa.string()), read_field("text", data, begin + at[name], end, 0, 4))
        for name in ("system", "subsystem")
    }
    short = ((size < STANDARD_LENGTH) | (extended & (size < EXTENDED_LENGTH))) & ~missing
    times = read_field("day_time", data, begin + at["time"], end, 0, 0)
    dates = read_field("day", data, begin + at["date"], end, 0, 0)
    return [
        pc.coalesce(errors, pc.if_else(pa.array(short), "short record", pa.scalar(None, pa.string()))),
        times,
        dates,
        names["system"],
        pc.if_else(pa.array(record_type == SUBTYPE_OVER_SUBSYSTEM), "", names["subsystem"]),
        pa.array(record_type),
        pa.array(number(at["subtype"], "u16")),
        pa.array(number(at["flags"], "u8")),
    ]


def decode_header(records: DataFrame) -> DataFrame:
    """Add the header columns to framed records; rows that have no header get an ``error``.

    Input: ``source_file, record_seq, byte_offset, body, error`` (and more, which is kept).
    """
    kept = [c for c in records.columns if c != "error"]
    body = kept.index("body")
    given = records.select(*kept, "error")
    added = [StructField(name, _parse_datatype_string(kind)) for name, kind in HEADER_TYPES.items()]
    schema = StructType([*[given.schema[c] for c in kept], *added])
    names = schema.names

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = batch.columns
                yield pa.RecordBatch.from_arrays([*columns[:-1], *_headers(columns[body], columns[-1])], names)

    return given.mapInArrow(each, schema)
