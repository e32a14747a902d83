"""Record layouts as data: where the section directory is, and which field lies where.

Correcting an offset means editing a line here; no plan changes. All offsets, widths and codes in
this module are fixed values of the record formats.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Field kinds and the column type each gives.
KIND_TYPES = {
    "u8": "smallint",
    "u16": "int",
    "u32": "bigint",
    "u64": "decimal(20,0)",
    "text": "string",
    "hex": "string",
    "hexfloat": "double",
    "seconds": "double",  # u32 hundredths / 100
    "millis": "bigint",  # u32 hundredths * 10
    "seconds64": "double",  # u64 hundredths / 100
    "flag": "boolean",
    "u64_list": "array<decimal(20,0)>",
    "cpu_count": "bigint",
    "cpu_millis": "bigint",
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    section: int | str
    offset: int
    width: int = 0
    #: ``cpu_*`` kinds roll up the entries of a section whose type byte equals this code
    code: int | None = None


@dataclass(frozen=True)
class Layout:
    table: str
    record_type: int
    #: subtypes routed here; empty means every subtype
    subtypes: tuple[int, ...]
    #: position of the first section-directory entry
    directory: int
    fields: tuple[Field, ...]
    #: section that gives one row per entry; None means one row per record
    rows: int | None = None
    #: directory entries are u32, u16, u16 instead of three u32
    compact: bool = False
    #: columns taken from the product section (always section 0)
    interval: tuple[str, ...] = ()
    #: row section lies in the nested directory of this section
    nested_in: int | None = None
    #: entries are kept only if (byte at offset & mask) is not zero
    valid_bit: tuple[int, int] | None = None
    #: sections read besides the row section
    sections: tuple[int, ...] = field(init=False)

    @property
    def entry_bytes(self) -> int:
        """Length of a directory entry."""
        return 8 if self.compact else 12

    def __post_init__(self):
        used = {f.section for f in self.fields if f.section != "row"}
        if self.interval:
            used.add(0)
        if self.nested_in is not None:
            used.add(self.nested_in)
        object.__setattr__(self, "sections", tuple(sorted(used)))


def _fields(section, *specs) -> tuple[Field, ...]:
    return tuple(Field(name, kind, section, *rest) for name, kind, *rest in specs)


START, SPAN, SAMPLES, PLEX = "interval_start_ts", "interval_ms", "sample_count", "sysplex_name"

#: Product section: position of each value the interval columns are made of.
PRODUCT = {"time": 9, "date": 13, "interval": 17, "samples": 21, "sysplex": 40, "sysplex_width": 8}

#: Entry of the processor section: wait time, parked time, processor type code and the two codes
#: that are reported. Parked time has no known position yet and reads as NULL.
CPU_ENTRY = {"wait": 0, "parked": None, "type": 13, "general": 0, "ziip": 2}

_COMMON_1154 = _fields(
    0,
    ("system_name", "text", 0, 8),
    ("sysplex_name", "text", 8, 8),
    ("job_name", "text", 16, 8),
    ("request_id", "text", 32, 8),
)

LAYOUTS: tuple[Layout, ...] = (
    Layout(
        "smf30", 30, (), 22,
        _fields(1, ("job_name", "text", 0, 8), ("step_name", "text", 8, 8),
                ("job_id", "text", 16, 8), ("program_name", "text", 24, 8))
        + _fields(3, ("elapsed_sec", "seconds", 0), ("cpu_sec", "seconds", 4))
        + _fields(4, ("tcb_sec", "seconds", 0), ("srb_sec", "seconds", 4),
                  ("ziip_sec", "seconds", 8))
        + _fields(2, ("excp_count", "u32", 0)),
    ),
    Layout(
        "smf70-1", 70, (1,), 22,
        _fields(1, ("cpc_model", "text", 0, 4), ("zaap_online", "u16", 22),
                ("ziip_online", "u16", 24))
        + tuple(
            Field(name, kind, 2, offset if offset is not None else -1, 0, code)
            for name, kind, offset, code in (
                ("cp_count", "cpu_count", 0, CPU_ENTRY["general"]),
                ("cp_wait_ms", "cpu_millis", CPU_ENTRY["wait"], CPU_ENTRY["general"]),
                ("cp_parked_ms", "cpu_millis", CPU_ENTRY["parked"], CPU_ENTRY["general"]),
                ("ziip_lp_count", "cpu_count", 0, CPU_ENTRY["ziip"]),
                ("ziip_wait_ms", "cpu_millis", CPU_ENTRY["wait"], CPU_ENTRY["ziip"]),
                ("ziip_parked_ms", "cpu_millis", CPU_ENTRY["parked"], CPU_ENTRY["ziip"]),
            )
        ),
        interval=(START, SPAN, SAMPLES, PLEX),
    ),
    Layout(
        "smf70-2", 70, (2,), 26,
        _fields("row", ("card_index", "u16", 0), ("card_type", "u16", 2),
                ("ops_count", "hexfloat", 24), ("exec_time", "hexfloat", 16)),
        rows=1, interval=(START, SPAN, PLEX),
    ),
    Layout(
        "smf71-1", 71, (1,), 24,
        _fields(1, ("total_page_ins", "u32", 0), ("total_page_outs", "u32", 4),
                ("avg_avail_frames", "u32", 16), ("max_avail_frames", "u32", 20),
                ("min_avail_frames", "u32", 24), ("fixed_frames", "u32", 32)),
        compact=True, interval=(START, SPAN, PLEX),
    ),
    Layout(
        "smf72-3", 72, (3,), 22,
        _fields(1, ("policy_name", "text", 0, 8), ("workload_name", "text", 8, 8),
                ("class_name", "text", 16, 8))
        + _fields("row", ("period_num", "u32", 0), ("importance", "u32", 4),
                  ("service_units", "u64", 8), ("cpu_units", "u64", 16), ("ioc_units", "u64", 24),
                  ("mso_units", "u64", 32), ("srb_units", "u64", 40), ("trans_ended", "u32", 56),
                  ("trans_elapsed_sec", "seconds64", 60)),
        rows=4, interval=(START, SPAN),
    ),
    Layout(
        "smf73-1", 73, (1,), 22,
        _fields("row", ("chpid", "hex", 0, 1), ("chpid_type", "u8", 1),
                ("chpid_acronym", "text", 16, 4), ("busy_count", "u32", 4)),
        rows=2, interval=(START, SPAN, PLEX), valid_bit=(2, 0x02),
    ),
    # The published description of this entry is not at hand: our own, contiguous in column order.
    Layout(
        "smf74-1", 74, (1,), 26,
        _fields("row", ("device_num", "text", 0, 4), ("volume_serial", "text", 4, 6),
                ("storage_group", "text", 10, 8), ("device_flags", "u8", 18),
                ("ssch_count", "u32", 20), ("connect_ms", "millis", 24),
                ("pending_ms", "millis", 28), ("active_ms", "millis", 32),
                ("disconnect_ms", "millis", 36), ("queue_depth", "u32", 40)),
        rows=2, interval=(START, SPAN, SAMPLES, PLEX),
    ),
    Layout(
        "smf74-2p", 74, (2,), 26,
        _fields("row", ("system_name", "text", 0, 8), ("device_num", "u16", 8),
                ("direction", "u8", 11), ("signals_sent", "u32", 38),
                ("other_system", "text", 13, 8)),
        rows=3, interval=(START, PLEX),
    ),
    Layout(
        "smf74-2m", 74, (2,), 26,
        _fields("row", ("system_name", "text", 0, 8), ("group_name", "text", 8, 8),
                ("member_name", "text", 16, 16), ("signals_sent", "u32", 35),
                ("signals_rcvd", "u32", 39)),
        rows=4, interval=(START, PLEX),
    ),
    Layout(
        "smf74-3", 74, (3,), 26,
        _fields(1, ("syscall_count", "u32", 12), ("syscall_cpu_ms", "u32", 24),
                ("max_processes", "u32", 72), ("max_users", "u32", 76),
                ("current_processes", "u32", 84), ("current_users", "u32", 96)),
        interval=(START, SPAN, PLEX),
    ),
    Layout(
        "smf74-4", 74, (4,), 26,
        _fields(1, ("cf_name", "text", 0, 8), ("cf_level", "u8", 101), ("total_req", "u32", 52))
        + _fields("row", ("structure_name", "text", 0, 16), ("size_4k", "u32", 16)),
        rows=4, interval=(START, SPAN, PLEX),
    ),
    Layout(
        "smf74-5", 74, (5,), 26,
        _fields("row", ("volser", "text", 0, 8), ("device_num", "u16", 10), ("read_req", "u32", 18),
                ("read_hit", "u32", 22), ("write_req", "u32", 26), ("write_hit", "u32", 30)),
        rows=2, interval=(START, SPAN, PLEX),
    ),
    Layout(
        "smf74-6", 74, (6,), 26,
        _fields(1, ("max_virtual_mb", "u32", 0), ("inuse_virtual_pages", "u32", 4),
                ("min_fixed_mb", "u32", 8), ("inuse_fixed_pages", "u32", 12),
                ("metadata_hits", "hexfloat", 16), ("metadata_misses", "hexfloat", 24)),
        interval=(START, PLEX),
    ),
    Layout(
        "smf74-7", 74, (7,), 28,
        _fields("row", ("port_num", "u16", 0), ("port_addr", "u16", 2),
                ("words_rcvd", "hexfloat", 28), ("words_sent", "hexfloat", 36),
                ("frames_rcvd", "hexfloat", 44), ("frames_sent", "hexfloat", 52)),
        rows=3, interval=(START, PLEX),
    ),
    Layout(
        "smf74-8", 74, (8,), 26,
        _fields("row", ("pool_id", "u32", 0), ("pool_type", "u32", 4), ("real_cap_gb", "u32", 12),
                ("real_extents", "u32", 16), ("real_alloc", "u32", 20)),
        rows=3, interval=(START, SPAN, PLEX),
    ),
    Layout(
        "smf74-9", 74, (9,), 26,
        _fields("row", ("pfid", "u32", 0), ("job_name", "text", 28, 8), ("asid", "u16", 36),
                ("func_type", "u8", 114), ("load_ops", "u64", 56), ("store_ops", "u64", 64)),
        rows=1, interval=(START, SPAN, PLEX),
    ),
    # As for 74-1: our own entry, contiguous in column order.
    Layout(
        "smf75-1", 75, (1,), 26,
        _fields("row", ("dsn", "text", 0, 44), ("volume_serial", "text", 44, 6),
                ("pst_flags", "u8", 50), ("total_slots", "u32", 52), ("max_slots_used", "u32", 56),
                ("min_slots_used", "u32", 60), ("avg_slots_used", "u32", 64),
                ("sio_count", "u32", 68), ("pages_transferred", "u32", 72)),
        rows=1, interval=(START, SPAN, SAMPLES, PLEX),
    ),
    Layout(
        "smf76-1", 76, (1,), 26,
        _fields(2, ("page_ins", "u32", 0), ("page_outs", "u32", 4), ("swap_ins", "u32", 8),
                ("swap_outs", "u32", 12), ("frame_count", "u32", 16), ("working_set", "u32", 20)),
        interval=(START, SPAN, PLEX),
    ),
    Layout(
        "smf77-1", 77, (1,), 26,
        _fields("row", ("major_name", "text", 0, 8), ("minor_name", "text", 8, 44),
                ("total_wait_ms", "u32", 60), ("max_wait_ms", "u32", 56)),
        rows=2, interval=(START, SPAN, SAMPLES, PLEX),
    ),
    Layout(
        "smf78-3", 78, (3,), 28,
        _fields("row", ("lcu_id", "hex", 0, 2), ("css_id", "u8", 2), ("queue_len_sum", "u32", 16),
                ("queue_len_count", "u32", 20)),
        rows=2, interval=(START, SPAN, PLEX),
    ),
    Layout(
        "smf79-1", 79, (1,), 26,
        _fields("row", ("asid", "u16", 0), ("job_name", "text", 2, 8), ("total_cpu_ms", "u32", 32),
                ("real_frames", "u32", 50), ("service_class", "text", 98, 8),
                ("ziip_ms", "u32", 183)),
        rows=2, interval=(START, SPAN, PLEX),
    ),
    Layout(
        "smf79-2", 79, (2,), 26,
        _fields("row", ("asid", "u16", 0), ("job_name", "text", 2, 8), ("total_cpu_ms", "u32", 32),
                ("fixed_frames", "u32", 86), ("service_class", "text", 116, 8)),
        rows=2, interval=(START, SPAN, PLEX),
    ),
    Layout(
        "smf79-13", 79, (13,), 26,
        _fields("row", ("event_type", "u16", 0), ("event_data", "text", 2, 8)),
        rows=2, interval=(START, PLEX),
    ),
    Layout(
        "smf98", 98, (), 32,
        _fields("row", ("asid", "u16", 0), ("job_name", "text", 2, 8)),
        rows=11, compact=True,
    ),
    Layout(
        "smf113", 113, (1, 2), 26,
        _fields(1, ("cpu_id", "u16", 14), ("cpu_class", "u8", 28))
        + _fields(2, ("counters", "u64_list", 0)),
        compact=True,
    ),
    Layout(
        "smf1154-1", 1154, (1,), 32,
        _COMMON_1154
        + _fields("row", ("stack_name", "text", 0, 8), ("ip_version", "u8", 8),
                  ("up_time_sec", "u32", 12)),
        rows=0, nested_in=1,
    ),
    Layout(
        "smf1154-2", 1154, (2,), 32,
        _COMMON_1154
        + _fields("row", ("anonymous_allowed", "flag", 4), ("inactivity_timeout", "u16", 21),
                  ("port_min", "u16", 27), ("port_max", "u16", 29),
                  ("sec_session_reuse", "text", 111, 1)),
        rows=0, nested_in=1,
    ),
    Layout(
        "smf1154-83", 1154, (83,), 32,
        _COMMON_1154
        + _fields("row", ("racf_active", "flag", 0), ("min_password_len", "u16", 11),
                  ("password_history", "u16", 13), ("password_interval", "u16", 15)),
        rows=0, nested_in=1,
    ),
)

BY_TABLE = {layout.table: layout for layout in LAYOUTS}

#: Types kept as header-only rows when no layout matches their subtype.
HEADER_ONLY_TYPES = (70, 71, 72, 73, 74, 75, 76, 77, 78, 79, 99, 113, 1154)

#: Types whose every record lands in a typed or header-only table; all others are ``raw``.
KNOWN_TYPES = tuple(sorted({30, 98, *HEADER_ONLY_TYPES}))

#: Columns every table starts with, in this order.
COMMON_COLUMNS = {
    "smf_timestamp": "timestamp",
    "smf_date": "date",
    "system_id": "string",
    "subsystem_id": "string",
    "record_type": "int",
    "subtype": "int",
    "flags": "smallint",
    "source_file": "string",
    "ingest_ts": "timestamp",
}

#: Columns every table ends with: where in which input the row came from.
LINEAGE_COLUMNS = {
    "record_seq": "bigint",
    "entry_seq": "int",
    "file_hash": "string",
    "run_id": "string",
}

_INTERVAL_TYPES = {START: "timestamp", SPAN: "bigint", SAMPLES: "int", PLEX: "string"}


def columns_of(table: str) -> dict[str, str]:
    """Column names and types of a table, in order; unknown names are header-only tables."""
    middle: dict[str, str] = {}
    if table == "raw":
        middle = {"body": "binary"}
    elif table in BY_TABLE:
        layout = BY_TABLE[table]
        middle = {name: _INTERVAL_TYPES[name] for name in layout.interval}
        middle |= {f.name: KIND_TYPES[f.kind] for f in layout.fields}
    return {**COMMON_COLUMNS, **middle, **LINEAGE_COLUMNS}


def schema_of(table: str) -> str:
    """The schema as DDL text, for readers."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns_of(table).items())
