"""Public lists that say whether a span can be what it looks like: endings of domains, card issuers, address ranges, calling codes."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from ipaddress import IPv6Address, ip_network

# Endings of domains in wide use, without and with a country.
GENERIC_ENDINGS = "com org net edu gov mil int info biz name pro io co ai app dev me tv cc xyz online site shop store blog cloud tech eu asia".split()
COUNTRY_ENDINGS = ("ae al am ar at au az ba bd be bg bh bo br by ca ch cl cn cr cu cy cz de dk do dz ec ee eg es et fi fr ge gh gr gt hk hn hr hu id ie il in iq ir is it jo jp ke "
                   "kg kr kw kz lb lk lt lu lv ly ma md mg mk mm mn mt mx my mz ng ni nl no np nz om pa pe ph pk pl pt py qa ro rs ru sa sd se sg si sk sn sv sy th tj tn tr tw tz "
                   "ua ug uk us uy uz ve vn ye za zm zw").split()
# First digits of card numbers (from, to) and the lengths their issuers use.
ISSUERS = (
    ("2221", "2720", {16}), ("300", "305", {14, 16, 17, 18, 19}), ("34", "34", {15}), ("3528", "3589", {16, 17, 18, 19}), ("36", "36", {14, 15, 16, 17, 18, 19}),
    ("37", "37", {15}), ("38", "39", {14, 16, 17, 18, 19}), ("4", "4", {13, 16, 19}), ("50", "50", {13, 14, 15, 16, 17, 18, 19}), ("51", "55", {16}),
    ("56", "58", {13, 14, 15, 16, 17, 18, 19}), ("6011", "6011", {16, 17, 18, 19}), ("62", "62", {16, 17, 18, 19}), ("6304", "6304", {13, 14, 15, 16, 17, 18, 19}),
    ("644", "649", {16, 17, 18, 19}), ("65", "65", {16, 17, 18, 19}), ("6759", "6763", {13, 14, 15, 16, 17, 18, 19}), ("9792", "9792", {16}))
# Address blocks that name no host of the public net; those of private nets may still tell a person's machine.
NOWHERE = ("0.0.0.0/8", "192.0.2.0/24", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4")
PRIVATE = ("10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.168.0.0/16")
GLOBAL6, NOWHERE6 = "2000::/3", "2001:db8::/32"
# Calling codes of one and two digits; all other codes have three digits and begin with one of the last list.
CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
LONG_CODES = "21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split()


def _ranges(blocks: tuple[str, ...]) -> list[tuple[int, int]]:
    return sorted((int(n.network_address), int(n.broadcast_address)) for n in map(ip_network, blocks))


def _inside(ranges: list[tuple[int, int]], at: int) -> bool:
    k = bisect_right(ranges, (at, 1 << 128)) - 1
    return k >= 0 and at <= ranges[k][1]


@dataclass(frozen=True)
class Gazetteer:
    """The lists as parameters. Each method gives 1 for what a list knows, -1 for what it rules out, 0 where it has nothing to say."""

    endings: frozenset[str] = frozenset(GENERIC_ENDINGS + COUNTRY_ENDINGS)
    issuers: tuple = ISSUERS
    nowhere: tuple[str, ...] = NOWHERE
    private: tuple[str, ...] = PRIVATE
    codes: frozenset[str] = frozenset(CODES)
    long_codes: frozenset[str] = frozenset(LONG_CODES)

    def __post_init__(self):
        for name in ("nowhere", "private"):
            object.__setattr__(self, f"_{name}", _ranges(getattr(self, name)))
        object.__setattr__(self, "_global6", ip_network(GLOBAL6))
        object.__setattr__(self, "_nowhere6", ip_network(NOWHERE6))

    def domain(self, ending: str) -> int:
        return 1 if ending in self.endings else 0

    def card(self, digits: str) -> int:
        for low, high, lengths in self.issuers:
            if low <= digits[:len(low)] <= high:
                return 1 if len(digits) in lengths else -1
        return -1

    def address(self, text: str) -> int:
        if ":" in text:
            at = IPv6Address(text)
            return -1 if at in self._nowhere6 else 1 if at in self._global6 else 0
        parts = [int(p) if len(p) < 9 else 256 for p in text.split(".")]
        if any(p > 255 for p in parts):
            return -1
        at = (parts[0] << 24) | (parts[1] << 16) | (parts[2] << 8) | parts[3]
        return -1 if _inside(self._nowhere, at) else 0 if _inside(self._private, at) else 1

    def phone(self, text: str, digits: str) -> int:
        """Numbers with a country code, written + or 00; others can't be told by their beginning."""
        if text[0] != "+":
            if not digits.startswith("00"):
                return 0
            digits = digits[2:]
        return 1 if digits[:1] in self.codes or digits[:2] in self.codes or digits[:2] in self.long_codes else -1
