"""Everything that names an institution, a list or a threshold, in one place.

The defaults suit the driver tables: the "institution" whose own units must
not count as companies is called ``Firm 1`` there.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Generic entries that are never real companies.
PLACEHOLDER_NAMES = (
    "[Venture in formation]",
    "AI-Driven Crop Optimization",
    "Advanced Battery Materials",
    "Precision Medicine Platform",
    "Sustainable Protein Production",
    "Quantum Computing Algorithms",
    "Smart Infrastructure Sensors",
)

# Host pattern -> credibility 1 (untrusted) .. 5 (authoritative).
SOURCE_TIERS = {
    ".edu": 5, ".gov": 5, ".org": 4,
    "crunchbase.com": 5, "pitchbook.com": 5, "techcrunch.com": 4,
    "linkedin.com": 3, "reuters.com": 4, "bloomberg.com": 4,
    "forbes.com": 3, "wikipedia.org": 3,
    "medium.com": 2, "reddit.com": 2, "quora.com": 1,
}

# Weight of each signal in the confidence score.
SIGNAL_WEIGHTS = {
    "directory": 0.45,
    "api": 0.35,
    "extra_source": 0.12,
    "strong_tie": 0.20,
    "verdict": 0.25,
}


@dataclass(frozen=True)
class Config:
    """Parameters of a run; pass your own to every job."""

    #: names under which the institution itself appears (regex fragments)
    institution_names: tuple[str, ...] = ("firm 1", "firm 2")
    #: word looked for as a sign of a tie to the institution
    institution_word: str = "the"
    #: names that are funds, programmes or placeholders, never companies
    blocklist: tuple[str, ...] = PLACEHOLDER_NAMES + ("Firm 3", "Firm 12 Ventures", "Firm 77, Inc.")
    #: (pattern, school) in the order they are tried, then the institution itself
    school_patterns: tuple[tuple[str, str], ...] = (
        (r"tech\s+campus", "tech"),
        (r"medical\s+college|class\s+of", "medical"),
        (r"veterinary|vet\s+school", "vet"),
    )
    #: pattern that shows a tie to the institution, and the school it stands for
    school_default: tuple[str, str] = ("manager", "main")
    #: hosts whose listing is itself a founding assertion
    directory_domains: tuple[str, ...] = ("list.example.org", "thther.example.org", "ththed.example.org")
    #: credibility per host pattern, longest match wins
    source_tiers: dict = field(
        default_factory=lambda: dict(SOURCE_TIERS, **{"thther.example.org": 2, "example.com": 3, "example.net": 1})
    )
    default_source_tier: int = 2
    signal_weights: dict = field(default_factory=lambda: dict(SIGNAL_WEIGHTS))
    publish_threshold: float = 0.70
    #: url used as proof when a record has none
    fallback_proof_url: str = "https://directory.example.org/"
    #: text between the prompt and the reply of a captured model session
    prompt_marker: str = "===END_PROMPT===REPLY_BELOW==="
    #: name of the processes whose orphans are looked for
    watched_process: str = "chrome.exe"


DEFAULT = Config()
