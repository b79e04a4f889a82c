"""Addresses and network specifications as bit strings."""

from __future__ import annotations

import ipaddress
import re

import pandas as pd

BITS_DDL = "family INT, bits STRING"
SPEC_DDL = "family INT, plen INT, prefix_bits STRING, spec_error STRING"


def _bits(text: str) -> tuple[int, str]:
    """Family and bits of a literal; an IPv4-mapped IPv6 address counts as IPv4."""
    address = ipaddress.ip_address(text)
    if address.version == 6 and address.ipv4_mapped:
        address = address.ipv4_mapped
    return address.version, format(int(address), f"0{address.max_prefixlen}b")


def address_bits(addresses: pd.Series) -> pd.DataFrame:
    rows = []
    for text in addresses:
        try:
            rows.append(_bits(text))
        except ValueError:
            rows.append((None, None))
    return pd.DataFrame(rows, columns=["family", "bits"]).astype({"family": "Int32"})


def _spec(host: str | None, network: str | None):
    if host is not None:
        try:
            family, bits = _bits(host)
        except ValueError:
            return None, None, None, f"not an address literal: {host}"
        return family, len(bits), bits, None
    if network is None:
        return None, None, None, "neither host nor network"
    base, slash, length = network.partition("/")
    if not slash or not re.fullmatch(r"[+-]?[0-9]+", length):
        return None, None, None, f"not base/length: {network}"
    try:
        family, bits = _bits(base)
    except ValueError:
        return None, None, None, f"not an address literal: {base}"
    plen = int(length)
    if not 0 <= plen <= len(bits):
        return None, None, None, f"prefix length out of range: {network}"
    return family, plen, bits[:plen], None


def client_specs(hosts: pd.Series, networks: pd.Series) -> pd.DataFrame:
    text = lambda v: None if pd.isna(v) else v
    rows = [_spec(text(h), text(n)) for h, n in zip(hosts, networks)]
    return pd.DataFrame(rows, columns=["family", "plen", "prefix_bits", "spec_error"]).astype(
        {"family": "Int32", "plen": "Int32"})
