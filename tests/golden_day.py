"""A fictional trading day as raw files: one symbol, a quote and a print per step, seeded draws."""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np

from chronotape.operators.normalize import Clocks

# The day's identity, the seed and the shape of its draws.
SYMBOL, INSTRUMENT = "ZZTEST", 900_001
OPEN_NS, CLOSE_NS = 1_789_738_200_000_000_000, 1_789_761_600_000_000_000
SEED, STEPS = 20_260_918, 1_000
AS_OF = CLOSE_NS
RECEIVED = 1_789_776_000_000_000_000  # 2026-09-19T00:00:00Z
PROCESSED = RECEIVED + 300_000_000_000
CLOCKS = Clocks(
    receive_time=RECEIVED, process_time=PROCESSED, raw_partition_id="fixture/tiny_day/000", event_time_source="sip"
)
REFERENCE = {
    "instrument": {
        "instrument_id": INSTRUMENT, "primary_exchange": "XNAS", "security_type": "common_stock", "lot_size": 100,
        "is_tradable": True, "effective_time": "2020-01-01T00:00:00.000000000Z",
    },
    "ticker_history": [
        {"instrument_id": INSTRUMENT, "ticker": SYMBOL, "effective_time": "2020-01-01T00:00:00.000000000Z", "end_time": None}
    ],
    "calendar": {
        "session_date": "2026-09-18", "is_trading_day": True, "regular_open_ns": OPEN_NS, "regular_close_ns": CLOSE_NS,
        "is_early_close": False, "opening_auction_ns": OPEN_NS, "closing_auction_ns": CLOSE_NS,
    },
}


def instant(ns: int) -> str:
    seconds, nanos = divmod(ns, 10**9)
    return f"{np.datetime64(seconds, 's')}.{nanos:09d}Z"


def lines() -> tuple[list[str], list[str]]:
    """(print lines, quote lines); prices are written as literal decimals, never as floats."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    at, cents = OPEN_NS, 5_000
    prints, quotes = [], []
    for step in range(STEPS):
        at += int(rng.integers(10**9, 3 * 10**9))
        cents = max(100, cents + int(rng.integers(-3, 4)) + (5_000 - cents) // 400)
        bid_size, ask_size, size = (100 * int(rng.integers(1, top)) for top in (20, 20, 10))
        ask = cents + (2 if step % 7 else -2)
        quotes.append(
            f'{{"S":"{SYMBOL}","T":"q","ap":{ask / 100:.2f},"as":{ask_size},"ax":"V","bp":{(cents - 1) / 100:.2f},'
            f'"bs":{bid_size},"bx":"V","c":["R"],"q":{2 * step + 1},"t":"{instant(at)}","z":"C"}}'
        )
        condition = "T" if step % 50 == 49 else "@"

        def print_line(trade_id: str, sequence: int, shares: int, cents=cents, at=at, condition=condition) -> str:
            return (
                f'{{"S":"{SYMBOL}","T":"t","c":["{condition}"],"i":"{trade_id}","p":{cents / 100:.2f},"q":{sequence},'
                f'"s":{shares},"t":"{instant(at + 250_000)}","x":"V","z":"C"}}'
            )

        prints.append(print_line(f"tr-{step:05d}", 2 * step + 2, size))
        if step == 100:
            prints.append(print_line("tr-collide", 2 * step + 2 + 100_000, 300))
    return prints, quotes


def write_day(root: Path, files: int = 1) -> Path:
    """Write the raw partition and its bundle; ``files`` > 1 spreads the lines over several files."""
    for name, rows in zip(("trades", "quotes"), lines(), strict=True):
        folder = root / "raw" / name
        folder.mkdir(parents=True)
        per_file = -(-len(rows) // files)
        for i in range(files):
            (folder / f"{i:04d}.ndjson").write_text("\n".join(rows[i * per_file : (i + 1) * per_file]) + "\n")
    (root / "reference.json").write_text(json.dumps(REFERENCE))
    return root
