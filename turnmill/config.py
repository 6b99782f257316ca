"""Parameters of a curation run. Everything here is a default that a caller may replace."""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Script:
    """A writing system: the inside of a regex character class and its token density."""

    name: str
    chars: str
    chars_per_token: float = 2.5
    other_chars_per_token: float = 4.0

    @property
    def has_ascii(self) -> bool:
        """Whether ASCII-only texts have to be tested; yes for classes only Java's regex knows."""
        try:
            return re.search(self.one, "".join(map(chr, range(128)))) is not None
        except re.error:
            return True

    @property
    def one(self) -> str:
        return f"[{self.chars}]"

    @property
    def run(self) -> str:
        return f"[{self.chars}]+"


@dataclass(frozen=True)
class Limits:
    min_ratio: float = 0.05
    max_tokens: int = 2000
    min_message_chars: int = 5
    dedup_chars: int = 500
    eval_share: float = 0.20


@dataclass(frozen=True)
class TokenLimits:
    warn: int = 3500
    max: int = 4096


@dataclass(frozen=True)
class Tier:
    """A source tier: its place in the keep-first order, quota share and acceptance rule."""

    name: str
    number: int
    fraction: float
    rule: str  # "target": must hold the script; "other": must not


# Results depend on them.
THAI = Script("thai", "\\u0E00-\\u0E7F")
TIERS = (
    Tier("autoif", 1, 0.40, "target"),
    Tier("sovereign", 2, 0.20, "target"),
    Tier("tulu_sft_en", 3, 0.40, "other"),
)
OTHER_LANGUAGE_TIER = "tulu_sft_en"
TARGET_SOURCE = "autoif"
SAMPLE_SOURCE_PREFIX = "ai2"
TOTAL_TARGET = 4000
SEED = 42
PROFILE_ROWS = 10_000
SAMPLE_ROWS = 1_000
PACKED_LENGTH = 4095
EFFECTIVE_BATCH = 16
# End of fixed values.


def tier_targets(total: int, tiers: tuple[Tier, ...] = TIERS) -> dict[str, int]:
    """Rows each tier may contribute; fractions are truncated."""
    return {tier.name: int(total * tier.fraction) for tier in tiers}
