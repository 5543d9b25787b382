"""URL normalisation after the WHATWG rules, as vectorized helpers.

Schemes other than http, https, ftp, ws and wss keep their host as it stands but for its case, or have none: then the path
either begins with a slash or is opaque. ``file`` URLs are not told from other text. International names are mapped by
the older IDNA tables but for ß and ς.
"""

from __future__ import annotations

import ipaddress
import re
import unicodedata
from collections.abc import Callable
from urllib.parse import quote, unquote_to_bytes

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):")
_PORTS = {"http": 80, "https": 443, "ftp": 21, "ws": 80, "wss": 443}
_PATH_SAFE = "!$%&'()*+,-./:;=@[\\]_|~"
_QUERY_SAFE = "!$%&()*+,-./:;=?@[\\]^_`{|}~"
_FORM_SAFE = "*-._"
_USER_SAFE = "!$%&'()*+,"
_PLAIN = "".join(map(chr, range(32, 127)))
_BAD_OPAQUE = re.compile(r"[\x00\t\n\r #/:<>?@\[\\\]^|]")
_BAD_HOST = re.compile(r"[\x00-\x20#%/:<>?@\[\\\]^|]")


def _path(raw: str, special: bool = True) -> str:
    out: list[str] = []
    parts = (raw.replace("\\", "/") if special else raw).split("/")[1:]
    for i, part in enumerate(parts):
        plain = part.lower().replace("%2e", ".")
        last = i == len(parts) - 1
        if plain == "..":
            out = out[:-1]
            if last:
                out.append("")
        elif plain == ".":
            if last:
                out.append("")
        else:
            out.append(quote(part, safe=_PATH_SAFE))
    return "/" + "/".join(out)


def _number(part: str) -> int | None:
    """A part of an IPv4 address: decimal, octal after 0, hexadecimal after 0x; None for any other text."""
    base, digits = (16, part[2:]) if part.startswith("0x") else (8, part[1:]) if len(part) > 1 and part[0] == "0" else (10, part)
    if not re.fullmatch("[0-9a-f]*", digits) or not part:
        return None
    try:
        return int(digits or "0", base)
    except ValueError:
        return None


def _address(host: str) -> str:
    """A host whose last label is a number as a dotted IPv4 address; ValueError where it is none. Other hosts stay."""
    parts = host.split(".")
    if len(parts) > 1 and not parts[-1]:
        parts.pop()
    if not re.fullmatch("[0-9]+", parts[-1]) and _number(parts[-1]) is None:
        return host
    numbers = [_number(x) for x in parts]
    if len(parts) > 4 or None in numbers or any(x > 255 for x in numbers[:-1]) or numbers[-1] >= 256 ** (5 - len(parts)):
        raise ValueError(host)
    whole = sum(x << 8 * (3 - i) for i, x in enumerate(numbers[:-1])) + numbers[-1]
    return ".".join(str(whole >> shift & 255) for shift in (24, 16, 8, 0))


def _six(text: str) -> str:
    """An IPv6 address in its shortest form: the first longest run of two zeros or more is left out; ValueError where it is none."""
    if "%" in text or text != text.strip():
        raise ValueError(text)
    whole = int(ipaddress.IPv6Address(text))
    pieces = [whole >> 16 * (7 - i) & 0xFFFF for i in range(8)]
    runs = [(next((j for j in range(i, 8) if pieces[j]), 8) - i, -i) for i in range(8)]
    length, at = max(runs)
    told = [f"{x:x}" for x in pieces]
    if length < 2:
        return ":".join(told)
    return ":".join(told[:-at]) + "::" + ":".join(told[-at + length :])


def _label(label: str) -> str:
    """A label of a host in ASCII; ß and ς stay letters of their own."""
    if re.search("[ßς]", label):
        return "xn--" + unicodedata.normalize("NFKC", label).encode("punycode").decode()
    return label.encode("idna").decode()


def _user(raw: str) -> str:
    """User name and password, escaped, with the sign that follows them; empty where both are."""
    name, _, secret = (quote(x, safe=_USER_SAFE) for x in raw.partition(":"))
    return f"{name}:{secret}@" if secret else f"{name}@" if name else ""


def _host(raw: str) -> str:
    if raw.startswith("["):
        return f"[{_six(raw[1:-1])}]"
    host = unquote_to_bytes(raw).decode("utf-8").lower()
    if not host.isascii():
        host = ".".join(map(_label, host.split(".")))
    if not host or _BAD_HOST.search(host):
        raise ValueError(raw)
    return _address(host)


def _placed(authority: str, name: str) -> str:
    """User, host and port as they are told; the port of the scheme is left out."""
    user, _, place = authority.rpartition("@")
    found = re.fullmatch(r"(\[[^\]]*\]|[^:]*)(?::([0-9]*))?", place)
    if not found:
        raise ValueError(authority)
    port = int(found[2]) if found[2] else None
    if port is not None and port > 65535:
        raise ValueError(authority)
    if name in _PORTS or found[1].startswith("["):
        host = _host(found[1])
    elif _BAD_OPAQUE.search(found[1]) or not found[1] and (user or port is not None):
        raise ValueError(authority)
    else:
        host = quote(found[1], safe=_PLAIN).lower()
    return _user(user) + host + (f":{port}" if port is not None and port != _PORTS.get(name) else "")


def parsed(raw: str) -> tuple[str, str, str | None, bool]:
    """(what comes before the path, path, query, whether the path is opaque) of a URL; ValueError for any other text."""
    text = re.sub(r"[\t\n\r]", "", raw.strip("".join(map(chr, range(33)))))
    scheme = _SCHEME.match(text)
    if not scheme or scheme[1].lower() == "file":
        raise ValueError(raw)
    name, rest = scheme[1].lower(), text[scheme.end() :].partition("#")[0]
    special = name in _PORTS
    if special:
        rest = "//" + re.sub(r"^[/\\]*", "", rest)
    before, mark, query = rest.partition("?")
    told = quote(query, safe=_QUERY_SAFE + ("%" if special else "%'")) if mark else None
    if before.startswith("//"):
        cut = re.search(r"[/\\]" if special else "/", before[2:])
        authority, path = (before[2:][: cut.start()], before[2:][cut.start() :]) if cut else (before[2:], "/" if special else "")
        return f"{name}://{_placed(authority, name)}", _path(path, special) if path else "", told, False
    if before.startswith("/"):
        path = _path(before, False)
        return f"{name}:" + ("/." if path.startswith("//") else ""), path, told, False
    return f"{name}:", quote(before, safe=_PLAIN), told, True


def _pairs(query: str) -> list[tuple[str, str]]:
    parts = [p.replace("+", " ").partition("=") for p in query.split("&") if p]
    return [(unquote_to_bytes(a).decode("utf-8", "replace"), unquote_to_bytes(b).decode("utf-8", "replace")) for a, _, b in parts]


def normal(raw: str | None, official: bool = False) -> str | None:
    """Normalised URL, or None for null and for what is no URL; ``official`` drops utm_ parameters first."""
    if raw is None:
        return None
    try:
        before, path, query, opaque = parsed(raw)
    except (ValueError, UnicodeError):
        return None
    if official and query and any(k.lower().startswith("utm_") for k, _ in _pairs(query)):
        kept = [(k, v) for k, v in _pairs(query) if not k.lower().startswith("utm_")]
        query = "&".join("=".join(quote(x, safe=_FORM_SAFE + " ").replace("~", "%7E").replace(" ", "+") for x in pair) for pair in kept) or None
    if path != "/" and path.endswith("/") and not opaque:
        path = path[:-1]
    return before + path + (f"?{query}" if query is not None and query != "" else "?" if query == "" else "")


def _once(column: pd.Series, one: Callable[[str], str | None]) -> pd.Series:
    """``one`` of every text, asked once for each distinct text of a batch; null for null."""
    places, texts = pd.factorize(column)
    told = np.array([*map(one, texts), None], dtype=object)  # the place of nulls is -1
    return pd.Series(told[places], index=column.index)


@F.pandas_udf(T.StringType())
def _normal(column: pd.Series) -> pd.Series:
    return _once(column, normal)


@F.pandas_udf(T.StringType())
def _official(column: pd.Series) -> pd.Series:
    return _once(column, lambda x: normal(x, True))


def normalize_url(url: Column) -> Column:
    """The URL without fragment and one trailing slash; null where it is no URL."""
    return _normal(url)


def normalize_official_url(url: Column) -> Column:
    """``normalize_url`` after dropping utm_ parameters; dropping any writes the whole query anew, form-encoded."""
    return _official(url)
