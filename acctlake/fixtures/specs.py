"""Which rows of the given tables stand for which record type (fixed values of the trial data)."""

from __future__ import annotations

from acctlake.fixtures.encode import Spec, n, pad, t, x
from acctlake.operators.layouts import BY_TABLE

_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_QTY = "CAST(l_quantity AS BIGINT)"
_JOB = "concat('JOB', l_linenumber)"
_PRICE = "CAST(round(p_retailprice * 100) AS BIGINT)"
_BIG = "CAST(18446744073709551615 AS DECIMAL(20,0))"


def _lines(table, record_type, subtype, lead, sections, repeated, **more):
    return Spec(table, "lineitem", record_type, subtype, lead, sections, repeated,
                interval=BY_TABLE[table].interval, **more)


def _parts(table, record_type, subtype, lead, sections, **more):
    return Spec(table, "part", record_type, subtype, lead, sections,
                interval=BY_TABLE[table].interval, **more)


_REQUEST = (
    t(8, "system_name", "rec_system"), t(8, "sysplex_name", "rec_plex"),
    t(8, "job_name", "concat('JOB', o_custkey % 100)"), pad(8),
    t(8, "request_id", "CAST(o_orderkey AS VARCHAR(20))"), pad(24),
)

_PATHS = (t(8, "system_name", "rec_system"), n(2, "device_num", "l_linenumber"), pad(1),
          n(1, "direction", "l_suppkey % 256"), pad(1), t(8, "other_system", _JOB), pad(17),
          n(4, "signals_sent", _CENTS), pad(58))
_MEMBERS = (t(8, "system_name", "rec_system"), t(8, "group_name", "concat('G', l_linenumber)"),
            t(16, "member_name", "concat('MEMBER', l_partkey)"), pad(3),
            n(4, "signals_sent", _QTY), n(4, "signals_rcvd", _CENTS), pad(12))

SPECS = {
    spec.table: spec
    for spec in (
        Spec("smf30", "events", 30, 4, 0, (
            None,
            (t(8, "job_name", "upper(event_type)"), t(8, "step_name", "concat('STEP', user_id % 10)"),
             t(8, "job_id", "concat('J', event_id % 1000000)"), t(8, "program_name", "'PGM'")),
            (n(4, "excp_count", "event_id"),),
            (n(4, "elapsed_sec", "user_id * 10", "user_id * 10 / 100.0"),
             n(4, "cpu_sec", "CAST(round(value * 100) AS BIGINT)",
               "CAST(round(value * 100) AS BIGINT) / 100.0")),
            (n(4, "tcb_sec", "user_id", "user_id / 100.0"),
             n(4, "srb_sec", "event_id % 977", "(event_id % 977) / 100.0"),
             n(4, "ziip_sec", "event_id % 13", "(event_id % 13) / 100.0")),
        )),
        _parts("smf70-1", 70, 1, 0, (
            "product",
            (t(4, "cpc_model", "CAST(8560 + p_size % 10 AS VARCHAR(20))"), pad(18),
             n(2, "zaap_online", "p_size"), n(2, "ziip_online", "p_size % 7"), pad(6)),
            # general, general or zIIP by the row, zIIP, and one of another type
            (n(4, None, "p_partkey"), pad(9), n(1, None, "0"), pad(2),
             n(4, None, "p_size"), pad(9), n(1, None, "(p_size % 2) * 2"), pad(2),
             n(4, None, _PRICE), pad(9), n(1, None, "2"), pad(2),
             n(4, None, "99"), pad(9), n(1, None, "5"), pad(2)),
        ), arrays={2: ("4", 16)}, extra=(
            ("cp_count", "2 - p_size % 2"),
            ("cp_wait_ms", "(p_partkey + CASE WHEN p_size % 2 = 0 THEN p_size ELSE 0 END) * 10"),
            ("cp_parked_ms", "NULL"),
            ("ziip_lp_count", "1 + p_size % 2"),
            ("ziip_wait_ms", f"({_PRICE} + CASE WHEN p_size % 2 = 0 THEN 0 ELSE p_size END) * 10"),
            ("ziip_parked_ms", "NULL"),
        )),
        _lines("smf70-2", 70, 2, 4, (
            "product",
            (n(2, "card_index", "l_linenumber"), n(2, "card_type", "l_suppkey % 65536"), pad(12),
             x("exec_time", _CENTS), x("ops_count", _QTY), pad(32)),
        ), (1,)),
        _parts("smf71-1", 71, 1, 2, (
            "product",
            (n(4, "total_page_ins", "p_partkey"), n(4, "total_page_outs", "p_size"), pad(8),
             n(4, "avg_avail_frames", _PRICE), n(4, "max_avail_frames", f"{_PRICE} * 2"),
             n(4, "min_avail_frames", "p_partkey + 1"), pad(4), n(4, "fixed_frames", "p_size * 3"),
             pad(28)),
        ), compact=True),
        _lines("smf72-3", 72, 3, 0, (
            "product",
            (t(8, "policy_name", "'POLICY1'"), t(8, "workload_name", "rec_plex"),
             t(8, "class_name", "rec_class"), pad(8)),
            None, None,
            (n(4, "period_num", "l_linenumber"), n(4, "importance", _QTY),
             n(8, "service_units", f"{_BIG} - l_partkey"), n(8, "cpu_units", _CENTS),
             n(8, "ioc_units", "l_partkey"), n(8, "mso_units", "l_suppkey"),
             n(8, "srb_units", "l_orderkey"), pad(8), n(4, "trans_ended", "l_orderkey % 1000"),
             n(8, "trans_elapsed_sec", _CENTS, f"{_CENTS} / 100.0")),
        ), (4,)),
        _lines("smf73-1", 73, 1, 0, (
            "product", None,
            (n(1, "chpid", "l_partkey % 256", "upper(right(concat('0', to_hex(l_partkey % 256)), 2))"),
             n(1, "chpid_type", "l_suppkey % 256"),
             n(1, None, "CASE WHEN l_linenumber <= 3 THEN 2 + 128 ELSE 1 + 16 END"), pad(1),
             n(4, "busy_count", _CENTS), pad(8), t(4, "chpid_acronym", "concat('C', l_linenumber)"),
             pad(12)),
        ), (2,)),
        _lines("smf74-1", 74, 1, 4, (
            "product", None,
            (t(4, "device_num", "concat('D', l_linenumber)"),
             t(6, "volume_serial", "concat('V', l_suppkey % 10000)"),
             t(8, "storage_group", "concat('SG', l_returnflag, l_linestatus)"),
             n(1, "device_flags", "l_partkey % 256"), pad(1), n(4, "ssch_count", "l_orderkey"),
             n(4, "connect_ms", _CENTS, f"{_CENTS} * 10"),
             n(4, "pending_ms", "1077952576", "10779525760"),
             n(4, "active_ms", _QTY, f"{_QTY} * 10"),
             n(4, "disconnect_ms", "l_partkey", "l_partkey * 10"), n(4, "queue_depth", "l_suppkey"),
             pad(28)),
        ), (2,)),
        _lines("smf74-2p", 74, 2, 4, ("product", None, None, _PATHS, _MEMBERS), (3, 4)),
        _lines("smf74-2m", 74, 2, 4, ("product", None, None, _PATHS, _MEMBERS), (3, 4)),
        _parts("smf74-3", 74, 3, 4, (
            "product",
            (pad(12), n(4, "syscall_count", _PRICE), pad(8), n(4, "syscall_cpu_ms", "p_partkey"),
             pad(44), n(4, "max_processes", "p_size * 100"), n(4, "max_users", "p_size * 10"), pad(4),
             n(4, "current_processes", "p_size * 7"), pad(8), n(4, "current_users", "p_size"),
             pad(220)),
        )),
        _lines("smf74-4", 74, 4, 4, (
            "product",
            (t(8, "cf_name", "rec_plex"), t(8, None, "rec_system"), pad(36),
             n(4, "total_req", "rec_interval"), pad(45), n(1, "cf_level", "rec_samples % 100"), pad(58)),
            None, None,
            (t(16, "structure_name", "concat('STRUCTURE', l_linenumber)"), n(4, "size_4k", _CENTS),
             pad(12)),
        ), (4,)),
        _lines("smf74-5", 74, 5, 4, (
            "product", None,
            (t(8, "volser", "concat('VOL', l_linenumber)"), pad(2),
             n(2, "device_num", "l_partkey % 65536"), pad(6), n(4, "read_req", _CENTS),
             n(4, "read_hit", "l_orderkey"), n(4, "write_req", "l_partkey"),
             n(4, "write_hit", "l_suppkey"), pad(14)),
        ), (2,)),
        _parts("smf74-6", 74, 6, 4, (
            "product",
            (n(4, "max_virtual_mb", "p_size * 64"), n(4, "inuse_virtual_pages", _PRICE),
             n(4, "min_fixed_mb", "p_size"), n(4, "inuse_fixed_pages", "p_partkey"),
             x("metadata_hits", _PRICE), x("metadata_misses", "p_size * 3"), pad(96)),
        )),
        _lines("smf74-7", 74, 7, 6, (
            "product", None, None,
            (n(2, "port_num", "l_linenumber"), n(2, "port_addr", "l_suppkey % 65536"), pad(24),
             x("words_rcvd", _CENTS), x("words_sent", "l_partkey"), x("frames_rcvd", "l_orderkey"),
             x("frames_sent", _QTY), pad(68)),
        ), (3,)),
        _lines("smf74-8", 74, 8, 4, (
            "product", None, None,
            (n(4, "pool_id", "l_suppkey"), n(4, "pool_type", "132 + l_linenumber"), pad(4),
             n(4, "real_cap_gb", _CENTS), n(4, "real_extents", "l_partkey"),
             n(4, "real_alloc", "l_orderkey")),
        ), (3,)),
        _lines("smf74-9", 74, 9, 4, (
            "product",
            (n(4, "pfid", "l_partkey"), pad(24), t(8, "job_name", _JOB),
             n(2, "asid", "l_orderkey % 65536"), pad(18), n(8, "load_ops", f"{_BIG} - l_orderkey"),
             n(8, "store_ops", f"CAST({_CENTS} AS DECIMAL(20,0)) * 1000000"), pad(42),
             n(1, "func_type", "l_linenumber"), pad(69)),
        ), (1,)),
        _lines("smf75-1", 75, 1, 4, (
            "product",
            (t(44, "dsn", "concat('SYS1.PAGE.', l_returnflag, '.P', l_partkey)"),
             t(6, "volume_serial", "concat('V', l_suppkey % 10000)"), n(1, "pst_flags", "l_partkey % 256"),
             pad(1), n(4, "total_slots", _CENTS), n(4, "max_slots_used", "l_partkey"),
             n(4, "min_slots_used", "l_suppkey"), n(4, "avg_slots_used", "l_orderkey"),
             n(4, "sio_count", _QTY), n(4, "pages_transferred", f"{_QTY} * 100"), pad(4)),
        ), (1,)),
        _parts("smf76-1", 76, 1, 4, (
            "product", None,
            (n(4, "page_ins", "p_partkey"), n(4, "page_outs", "p_size"), n(4, "swap_ins", "p_size + 1"),
             n(4, "swap_outs", "p_size + 2"), n(4, "frame_count", _PRICE),
             n(4, "working_set", "p_partkey * 2")),
        )),
        _lines("smf77-1", 77, 1, 4, (
            "product", None,
            (t(8, "major_name", "concat('MAJ', l_linenumber)"),
             t(44, "minor_name", "concat('SYS1.PROCLIB.MEMBER.', l_partkey, '.', l_suppkey)"),
             n(4, None, "1"), n(4, "max_wait_ms", "l_orderkey"), n(4, "total_wait_ms", _CENTS)),
        ), (2,)),
        _lines("smf78-3", 78, 3, 6, (
            "product", None,
            (n(2, "lcu_id", "l_partkey % 65536",
               "upper(right(concat('000', to_hex(l_partkey % 65536)), 4))"),
             n(1, "css_id", "l_linenumber"), pad(13), n(4, "queue_len_sum", _CENTS),
             n(4, "queue_len_count", _QTY), pad(8)),
        ), (2,)),
        _lines("smf79-1", 79, 1, 4, (
            "product", None,
            (n(2, "asid", "l_suppkey % 65536"), t(8, "job_name", _JOB), pad(22),
             n(4, "total_cpu_ms", _CENTS), pad(14), n(4, "real_frames", "l_partkey"), pad(44),
             t(8, "service_class", "concat('SC', l_returnflag)"), pad(77), n(4, "ziip_ms", _QTY), pad(33)),
        ), (2,)),
        _lines("smf79-2", 79, 2, 4, (
            "product", None,
            (n(2, "asid", "l_suppkey % 65536"), t(8, "job_name", _JOB), pad(22),
             n(4, "total_cpu_ms", _CENTS), pad(50), n(4, "fixed_frames", "l_partkey"), pad(26),
             t(8, "service_class", "concat('SC', l_linestatus)"), pad(36)),
        ), (2,)),
        _lines("smf79-13", 79, 13, 4, (
            "product", None,
            (n(2, "event_type", "l_linenumber"), t(8, "event_data", "concat('E', l_suppkey)")),
        ), (2,)),
        _lines("smf98", 98, 1, 10, (
            *[None] * 11,
            (n(2, "asid", "l_partkey % 65536"), t(8, "job_name", _JOB), pad(22)),
        ), (11,), compact=True),
        _parts("smf113", 113, 1, 4, (
            None,
            (pad(14), n(2, "cpu_id", "p_size"), pad(12), n(1, "cpu_class", "p_size % 3"), pad(3)),
            (n(8, None, f"{_BIG} - p_partkey"), n(8, None, "p_partkey"), n(8, None, _PRICE),
             n(8, None, "p_size")),
        ), compact=True, arrays={2: ("1 + p_size % 4", 8)}),
        Spec("smf1154-1", "orders", 1154, 1, 0, (_REQUEST, (
            t(8, "stack_name", "concat('TCP', o_custkey % 1000)"), n(1, "ip_version", "4 + (o_custkey % 2) * 2"),
            pad(3), n(4, "up_time_sec", "o_orderkey * 3"))), ),
        Spec("smf1154-2", "orders", 1154, 2, 0, (_REQUEST, (
            t(4, None, "'FDCF'"),
            n(1, "anonymous_allowed", "o_custkey % 2", "(o_custkey % 2) = 1"), pad(16),
            n(2, "inactivity_timeout", "o_custkey % 65536"), pad(4), n(2, "port_min", "o_orderkey % 1000"),
            n(2, "port_max", "o_orderkey % 1000 + 1000"), pad(80),
            t(1, "sec_session_reuse", "o_orderstatus"))), ),
        Spec("smf1154-83", "orders", 1154, 83, 0, (_REQUEST, (
            n(1, "racf_active", "o_orderkey % 2", "(o_orderkey % 2) = 1"), pad(10),
            n(2, "min_password_len", "o_custkey % 20"), n(2, "password_history", "o_custkey % 32"),
            n(2, "password_interval", "o_orderkey % 365"), pad(3))), ),
    )
}
