"""MPEG audio as a media column.

Reading: tags before and after the sound (ID3v2, ID3v1) are parsed, frame headers are found again after damage, tables of
variable bit rate (Xing, VBRI) are read, checksums are verified, and exact durations and the byte offset of every frame
are kept. Writing: any bytes become a valid stream of silent MPEG-1 Layer III frames which carry them as ancillary data.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import rows

# Fixed values of ISO 11172-3 and 13818-3: kbit/s by bit rate index, Hz by index, samples a frame.
BIT_RATES = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
SAMPLE_RATES = {1: (44100, 48000, 32000), 2: (22050, 24000, 16000), 2.5: (11025, 12000, 8000)}
SAMPLES = {(1, 1): 384, (1, 2): 1152, (1, 3): 1152, (2, 1): 384, (2, 2): 1152, (2, 3): 576}


@dataclass(frozen=True)
class Header:
    version: float
    layer: int
    bit_rate: int
    sample_rate: int
    channels: int
    protected: bool
    length: int
    samples: int
    side_info: int


@lru_cache(4096)
def header(four: bytes) -> Header | None:
    """The frame header in four bytes; None if it is none (free-format bit rates count as none)."""
    if len(four) < 4 or four[0] != 0xFF or four[1] & 0xE0 != 0xE0:
        return None
    version = {0: 2.5, 2: 2, 3: 1}.get(four[1] >> 3 & 3)
    layer = 4 - (four[1] >> 1 & 3)
    rate, hertz = four[2] >> 4, four[2] >> 2 & 3
    if version is None or layer == 4 or rate in (0, 15) or hertz == 3 or four[3] & 3 == 2:
        return None
    family = 1 if version == 1 else 2
    kbit, hz, samples = BIT_RATES[family, layer][rate], SAMPLE_RATES[version][hertz], SAMPLES[family, layer]
    padding = four[2] >> 1 & 1
    length = (12000 * kbit // hz + padding) * 4 if layer == 1 else samples // 8 * 1000 * kbit // hz + padding
    channels = 1 if four[3] >> 6 == 3 else 2
    side = {(1, 1): 17, (1, 2): 32, (2, 1): 9, (2, 2): 17}[family, channels] if layer == 3 else 0
    return Header(version, layer, kbit, hz, channels, not four[1] & 1, length, samples, side)


def _crc_table() -> list[int]:
    out = []
    for byte in range(256):
        value = byte << 8
        for _ in range(8):
            value = (value << 1 ^ 0x8005 if value & 0x8000 else value << 1) & 0xFFFF
        out.append(value)
    return out


_CRC = _crc_table()


@lru_cache(4096)
def crc16(data: bytes) -> int:
    """The checksum of MPEG audio: polynomial 8005, starting at FFFF."""
    value = 0xFFFF
    for byte in data:
        value = (value << 8 & 0xFFFF) ^ _CRC[value >> 8 ^ byte]
    return value


def crc16_bits(data: bytes, bits: int) -> int:
    """The same over the first so many bits."""
    value = crc16(data[: bits >> 3])
    for i in range(bits & ~7, bits):
        value = (value << 1 ^ 0x8005 if (value >> 15 ^ data[i >> 3] >> (7 - i % 8)) & 1 else value << 1) & 0xFFFF
    return value


# Bits of a subband's allocation in Layer II, by runs of subbands: MPEG-1, its low rates, and MPEG-2.
_ALLOCATION = {"full": ((4, 11), (3, 12), (2, 7)), "low": ((4, 2), (3, 10)), "half": ((4, 4), (3, 7), (2, 19))}


def protected_bits(frame: bytes, h: Header) -> int | None:
    """How many bits behind a frame's checksum it covers, beside the header's last two bytes; None if the frame is shorter.

    Layer I: the allocation of bits to 32 subbands. Layer II: the allocation, and two bits for each channel of a subband that has any. Layer III: the side information.
    """
    if h.layer == 3:
        return 8 * h.side_info if len(frame) >= 6 + h.side_info else None
    mode, extension = frame[3] >> 6, frame[3] >> 4 & 3
    joint = 32 if mode != 1 else 4 * (extension + 1)  # from this subband on both channels share their allocation
    if h.layer == 1:
        return 128 if h.channels == 1 else 4 * (2 * min(joint, 32) + 32 - min(joint, 32))
    rate = h.bit_rate // h.channels
    if h.version != 1:
        runs, bands = _ALLOCATION["half"], 30
    elif rate < 56:
        runs, bands = _ALLOCATION["low"], 12 if h.sample_rate == 32000 else 8
    else:
        runs, bands = _ALLOCATION["full"], 30 if rate >= 96 and h.sample_rate != 48000 else 27
    widths = [w for w, n in runs for _ in range(n)][:bands]
    number, at, more = int.from_bytes(frame[6:150], "big"), 0, 0
    size = 8 * len(frame[6:150])
    for band, width in enumerate(widths):
        apart = h.channels if band < joint else 1
        for _ in range(apart):
            if at + width > size:
                return None
            if number >> (size - at - width) & (1 << width) - 1:
                more += 2 * (h.channels // apart)
            at += width
    return at + more if at + more <= size else None


def _syncsafe(data: bytes) -> int:
    return data[0] << 21 | data[1] << 14 | data[2] << 7 | data[3]


def _text(data: bytes) -> str:
    """A text of an ID3v2 frame: its first byte names the encoding."""
    if not data:
        return ""
    kind = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(data[0], "latin-1")
    return data[1:].decode(kind, "replace").strip("\0")


@dataclass
class Audio:
    frames: int = 0
    samples: int = 0
    version: float | None = None
    layer: int | None = None
    sample_rate: int | None = None
    channels: int | None = None
    lost_bytes: int = 0
    crc_checked: int = 0
    crc_bad: int = 0
    table: str = ""
    table_frames: int | None = None
    table_bytes: int | None = None
    tags: dict[str, str] = field(default_factory=dict)
    offsets: list[int] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)

    @property
    def seconds(self) -> float:
        return self.samples / self.sample_rate if self.sample_rate else 0.0


def _tags(data: bytes, out: dict[str, str]) -> tuple[int, int]:
    """Fill in the tags; where the sound begins and ends."""
    start, end = 0, len(data)
    while data[start : start + 3] == b"ID3" and start + 10 <= end:
        major, flags = data[start + 3], data[start + 5]
        size = _syncsafe(data[start + 6 : start + 10])
        held = data[start + 10 : min(end, start + 10 + size)]
        if flags & 0x80 and major == 3:  # bytes that look like a frame header were parted by a zero
            held = held.replace(b"\xff\x00", b"\xff")
        at, stop = 0, len(held)
        if flags & 0x40 and stop >= 4:  # an extended header comes first; its size counts itself from version 4 on
            at = _syncsafe(held[:4]) if major == 4 else 4 + int.from_bytes(held[:4], "big")
        while major in (3, 4) and at + 10 <= stop and held[at : at + 4].strip(b"\0"):
            n = _syncsafe(held[at + 4 : at + 8]) if major == 4 else int.from_bytes(held[at + 4 : at + 8], "big")
            body = held[at + 10 : min(stop, at + 10 + n)]
            if major == 4:  # here each frame says for itself whether it was parted, and whether its plain length comes first
                body = body[4:] if held[at + 9] & 1 else body
                body = body.replace(b"\xff\x00", b"\xff") if held[at + 9] & 2 else body
            name = held[at : at + 4].decode("latin-1")
            if name == "TXXX":
                key, _, value = _text(body).partition("\0")
                out[f"TXXX:{key}"] = value
            elif name.startswith("T"):
                out[name] = _text(body)
            at += 10 + n
        start = min(end, start + 10 + size + (10 if flags & 0x10 else 0))
    if end - start >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        for key, a, b in (("title", 3, 33), ("artist", 33, 63), ("album", 63, 93), ("year", 93, 97)):
            if value := data[end + a : end + b].split(b"\0")[0].decode("latin-1").strip():
                out.setdefault(key, value)
    return start, end


def parse(data: bytes | None) -> Audio:
    """Everything about a stream. Null, empty or foreign bytes: no frames, and all bytes count as lost.

    A frame counts if its header is whole and followed by a header of the same kind or by the end; otherwise the search goes
    on at the next byte FF. The frame that holds a table of variable bit rate has no sound of its own.
    """
    out = Audio()
    data = bytes(data or b"")
    at, end = _tags(data, out.tags)
    synced = False
    while at + 4 <= end:
        h = header(data[at : at + 4])
        if h is not None:
            after = at + h.length
            follows = header(data[after : after + 4]) if after + 4 <= end else None
            good = after == end or (follows is not None and (follows.version, follows.layer, follows.sample_rate) == (h.version, h.layer, h.sample_rate)) or (synced and after < end)
            if after > end or not good:
                h = None
        if h is None:
            found = data.find(b"\xff", at + 1, end)
            found = end if found < 0 else found
            out.lost_bytes += found - at
            at, synced = found, False
            continue
        synced = True
        body = at + 4 + 2 * h.protected
        if h.protected:
            out.crc_checked += 1
            bits = 8 * h.side_info if h.layer == 3 else protected_bits(data[at : at + min(h.length, 150)], h)
            found = None if bits is None else crc16_bits(data[at + 2 : at + 4] + data[body : body + (bits + 7 >> 3)], 16 + bits)
            out.crc_bad += found != int.from_bytes(data[at + 4 : at + 6], "big")
        if not out.offsets and not out.table and h.layer == 3:
            tag = body + h.side_info
            if data[tag : tag + 4] in (b"Xing", b"Info"):
                out.table = data[tag : tag + 4].decode()
                flags, tag = int.from_bytes(data[tag + 4 : tag + 8], "big"), tag + 8
                if flags & 1:
                    out.table_frames, tag = int.from_bytes(data[tag : tag + 4], "big"), tag + 4
                if flags & 2:
                    out.table_bytes = int.from_bytes(data[tag : tag + 4], "big")
            elif data[at + 36 : at + 40] == b"VBRI":
                out.table = "VBRI"
                out.table_bytes, out.table_frames = int.from_bytes(data[at + 46 : at + 50], "big"), int.from_bytes(data[at + 50 : at + 54], "big")
            if out.table:
                at += h.length
                continue
        if out.version is None:
            out.version, out.layer, out.sample_rate, out.channels = h.version, h.layer, h.sample_rate, h.channels
        out.frames += 1
        out.samples += h.samples
        out.offsets.append(at)
        out.lengths.append(h.length)
        at += h.length
    if at < end:
        out.lost_bytes += end - at
    return out


#: What payloads are written as: MPEG-1 Layer III, mono, 32 kHz, with checksums; 4 bytes of header, 2 of checksum, 17 of side information.
_HERTZ_INDEX, _AROUND, _SIDE = 2, 23, 17
_LENGTHS = {i: 144 * kbit // 32 for i, kbit in enumerate(BIT_RATES[1, 3]) if kbit}


@lru_cache(32)
def _frame_start(rate_index: int) -> bytes:
    """Header, checksum and side information of a silent frame."""
    four = bytes([0xFF, 0xFA, rate_index << 4 | _HERTZ_INDEX << 2, 0xC0])
    return four + crc16(four[2:] + bytes(_SIDE)).to_bytes(2, "big") + bytes(_SIDE)


def store(payload: bytes) -> bytes:
    """A stream that carries the payload: an ID3v2 tag with its length, a frame with the table of variable bit rate, then silent frames.

    All frames are of 320 kbit/s but the last, which takes the least rate that holds the rest.
    """
    big = max(_LENGTHS)
    room = _LENGTHS[big] - _AROUND
    pieces, offsets, size = [], [], 0
    for at in range(0, len(payload), room):
        piece = payload[at : at + room]
        index = big if len(piece) == room else next(i for i, n in _LENGTHS.items() if n - _AROUND >= len(piece))
        pieces += [_frame_start(index), piece, bytes(_LENGTHS[index] - _AROUND - len(piece))]
        offsets.append(size)
        size += _LENGTHS[index]
    table_index = next(i for i, n in _LENGTHS.items() if n >= _AROUND + 120)
    whole = size + _LENGTHS[table_index]
    seek = bytes(min(255, (_LENGTHS[table_index] + offsets[len(offsets) * i // 100]) * 256 // whole) if offsets else 0 for i in range(100))
    table = b"Xing" + (7).to_bytes(4, "big") + len(offsets).to_bytes(4, "big") + whole.to_bytes(4, "big") + seek
    first = _frame_start(table_index) + table
    value = b"\x00payload\x00" + str(len(payload)).encode()
    tag_frame = b"TXXX" + len(value).to_bytes(4, "big") + b"\0\0" + value
    n = len(tag_frame)
    tag = b"ID3\x03\x00\x00" + bytes([n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127]) + tag_frame
    return b"".join([tag, first, bytes(_LENGTHS[table_index] - len(first)), *pieces])


def payload_of(data: bytes, audio: Audio) -> bytes:
    """The bytes that a stream of store() carries, cut from its frames."""
    n = int(audio.tags.get("TXXX:payload", "0") or 0)
    view = memoryview(data)
    return b"".join([view[at + _AROUND : at + length] for at, length in zip(audio.offsets, audio.lengths, strict=True)])[:n]


def padded(text: str | None) -> bytes:
    """UTF-8 with bytes 0 up to a positive multiple of 64."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))


def store_audio(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, media): each whole text, padded, as an MPEG stream. Null text: as empty. Repeated rows stay; an empty table gives an empty table; other columns, whatever their names, are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches, 256):
            texts = batch.column(1).to_pylist()
            sizes = [len((t or "").encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array([store(padded(t)) for t in texts], pa.binary())], [id_column, "n_bytes", "media"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, n_bytes long, media binary")


def read_audio(media: DataFrame, id_column: str = "doc_id", media_column: str = "media") -> DataFrame:
    """What parse() finds in each stream: kind, counts, exact samples and duration, table, checksums (of all layers), tags and the offset of every frame.

    Null, empty or foreign bytes give a row with 0 frames. Repeated rows stay; an empty table gives an empty table; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches, 256):
            found = [parse(x) for x in batch.column(1).to_pylist()]
            columns = [
                batch.column(0),
                pa.array([None if x.version is None else f"{x.version:g}" for x in found], pa.string()),
                pa.array([x.layer for x in found], pa.int32()),
                pa.array([x.sample_rate for x in found], pa.int32()),
                pa.array([x.channels for x in found], pa.int32()),
                pa.array([x.frames for x in found], pa.int64()),
                pa.array([x.samples for x in found], pa.int64()),
                pa.array([x.seconds for x in found], pa.float64()),
                pa.array([x.table for x in found], pa.string()),
                pa.array([x.table_frames for x in found], pa.int64()),
                pa.array([x.crc_checked for x in found], pa.int64()),
                pa.array([x.crc_bad for x in found], pa.int64()),
                pa.array([x.lost_bytes for x in found], pa.int64()),
                pa.array([list(x.tags.items()) for x in found], pa.map_(pa.string(), pa.string())),
                pa.array([x.offsets for x in found], pa.list_(pa.int64())),
            ]
            yield pa.record_batch(columns, names)

    names = [id_column, "version", "layer", "sample_rate", "channels", "frames", "samples", "seconds", "vbr_table", "table_frames", "crc_checked", "crc_bad", "lost_bytes", "tags", "frame_offsets"]
    kinds = "string, int, int, int, long, long, double, string, long, long, long, long, map<string,string>, array<long>".split(", ")
    kind = media.schema[id_column].dataType.simpleString()
    return media.select(id_column, media_column).mapInArrow(run, f"`{id_column}` {kind}, " + ", ".join(f"{n} {k}" for n, k in zip(names[1:], kinds, strict=True)))


def audio_digests(media: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Digests of the streams of store_audio(), read back from their bytes: payload, its tail, the stored form, and the features of parse().

    Repeated rows stay; an empty table gives an empty table; columns beside those of store_audio() are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches, 256):
            out: list[tuple] = []
            for data in batch.column(2).to_pylist():
                audio = parse(data)
                payload = payload_of(data, audio)
                spread = zlib.crc32(b"".join(x.to_bytes(8, "little") for x in audio.offsets))
                whole = audio.table_frames == audio.frames
                feature = f"mpeg{audio.version or 0:g} layer {audio.layer or 0}, {audio.sample_rate or 0} Hz, {audio.channels or 0} channel, frames {audio.frames}, samples {audio.samples}, table {audio.table} {'whole' if whole else 'differs'}, crc {audio.crc_checked - audio.crc_bad}/{audio.crc_checked}, lost {audio.lost_bytes}, seek {spread:08x}"
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature, audio.seconds))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
            yield pa.record_batch([batch.column(0), batch.column(1), *(pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True))], names)

    names = [id_column, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "seconds"]
    kind = media.schema[id_column].dataType.simpleString()
    return media.select(id_column, "n_bytes", "media").mapInArrow(run, f"`{id_column}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, seconds double")
