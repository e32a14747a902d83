"""Hand-made binary logs for tests."""

import struct


def packed(year: int, day: int) -> bytes:
    return bytes.fromhex(f"{year:04d}{day:03d}C")


def header(record_type: int, subtype: int | None = None, year=2025, day=100, time=360000,
           system="SYS1", subsystem="JES2") -> bytes:
    out = struct.pack(">HBBI", 0, 0, record_type, time) + packed(year, day)
    out += system.encode("cp037") + subsystem.encode("cp037")
    return out if subtype is None else out + struct.pack(">H", subtype)


def extended(record_type: int, subtype: int, system="SYS1") -> bytes:
    out = struct.pack(">HHIBBI", 0xFFFF, record_type, 0, 0, 0, 360000) + packed(2025, 100)
    return out + system.encode("cp037") + struct.pack(">HH", subtype, 2) + bytes(6)


def finish(body: bytes) -> bytes:
    """Header length filled in."""
    if body[:2] == b"\xff\xff":
        return body[:4] + struct.pack(">I", len(body)) + body[8:]
    return struct.pack(">H", len(body)) + body[2:]


def framed(body: bytes, segment: int = 0) -> bytes:
    return struct.pack(">HH", len(body) + 4, segment) + body


def device_record(entries: int, length: int = 32, offset: int | None = None, sections: int = 3,
                  time=120000) -> bytes:
    """Type 74-1: only the last section exists; its bytes are all 0x40."""
    body = header(74, 1, time=time) + struct.pack(">I", sections)
    start = 26 + 12 * sections if offset is None else offset
    body += bytes(12 * (sections - 1)) + struct.pack(">III", start, length, entries)
    if offset is None:
        body += b"\x40" * (length * entries)
    return finish(body)


def write(folder, name: str, data: bytes) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(data)
    return str(folder)
