"""Text forms in DuckDB SQL, for the oracles; the same fixed values as in functions.text."""

from __future__ import annotations

from postmill.functions.text import ACCENTED, LIGATURES, PLAIN, SHORT_FORMS, STOP_WORDS, STREET_TYPES
from postmill.schema import EARTH_RADIUS_M


def fold(x: str) -> str:
    out = f"lower({x})"
    for letter, two in LIGATURES:
        out = f"replace({out}, '{letter}', '{two}')"
    return rf"trim(regexp_replace(translate({out}, '{ACCENTED}', '{PLAIN}'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def _words(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def expand(folded: str) -> str:
    cases = " ".join(f"when t in ({_words(shorts)}) then '{word}'" for word, shorts in SHORT_FORMS.items())
    return f"array_to_string(list_transform(string_split({folded}, ' '), lambda t: case {cases} else t end), ' ')"


def without(expanded: str, words) -> str:
    return f"array_to_string(list_filter(string_split({expanded}, ' '), lambda t: t not in ({_words(words)})), ' ')"


def light(expanded: str) -> str:
    return without(expanded, STOP_WORDS)


def core(expanded: str) -> str:
    rest = without(expanded, STREET_TYPES + STOP_WORDS)
    return f"case when {rest} = '' then {expanded} else {rest} end"


def number_key(x: str) -> str:
    return rf"regexp_replace({fold(x)}, '(\d) (bis|ter|quater|[a-z])$', '\1\2')"


def postcode_key(x: str) -> str:
    return rf"upper(regexp_replace({x}, '\s+', '', 'g'))"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    return f"{2 * EARTH_RADIUS_M!r} * asin(sqrt(least(1.0, {a})))"


def cell_x(lon: str) -> str:
    return f"cast((cast(floor(({lon} + 180) / 360 * 8192) as bigint) % 8192 + 8192) % 8192 as integer)"


def cell_y(lat: str) -> str:
    return f"cast(greatest(0, least(4095, floor(({lat} + 90) / 180 * 4096))) as integer)"
