"""Fixed values that must equal the original tool's for equal results.

Everything here is data: the URL rule pack, the closed label set, the
tracking-parameter prefixes, the default column map and batch sizes.  The
host of the rule pack and the root domain are parameters; the shipped default
is the neutral ``shop.example``.
"""

from __future__ import annotations

import re

DEFAULT_ROOT_DOMAIN = "shop.example"

# --- fixed values: query keys removed during URL normalisation, matched as
# case-sensitive prefixes of the decoded key, in this order.
TRACKING_PARAM_PREFIXES = ("utm_", "gclid", "fbclid", "gclsrc", "mc_", "sc_")

# --- fixed values: href prefixes that never become links (case-sensitive).
SKIPPED_HREF_PREFIXES = ("#", "mailto:", "tel:", "javascript:", "data:")

# --- fixed values: the URL rule pack, most specific first.  ``{host}`` is the
# regex-escaped shop host.  Each rule: (label, pattern, flags).
RULE_PACK = [
    ("product", r"^https?://(?:www\.)?{host}/.+-p-[a-z0-9]+(?:[/?].*)?$", ["IGNORECASE"]),
    ("category", r"^https?://(?:www\.)?{host}/.+-c-\d+(?:/|$|\?.*)", ["IGNORECASE"]),
    ("campaign", r"^https?://(?:www\.)?{host}/kampanyalar(?:/|$|\?.*)", ["IGNORECASE"]),
    ("seller_store", r"^https?://(?:www\.)?{host}/magaza/[^/?#]+(?:[/?].*)?$", ["IGNORECASE"]),
    ("brand", r"^https?://(?:www\.)?{host}/marka/[^/?#]+(?:[/?].*)?$", ["IGNORECASE"]),
    ("help", r"^https?://(?:www\.)?{host}/yardim(?:/|$|\?.*)", ["IGNORECASE"]),
    ("policy", r"^https?://(?:www\.)?{host}/(?:gizlilik|kvkk|kisisel-veri|sozlesme|iade|kargo|teslimat)[^?#]*(?:[?#].*)?$", ["IGNORECASE"]),
    ("search", r"^https?://(?:www\.)?{host}/(?:ara|search)(?:/|$|\?.*)", ["IGNORECASE"]),
    ("account", r"^https?://(?:www\.)?{host}/(?:uyelik|giris|hesabim|sifre)[^?#]*(?:[?#].*)?$", ["IGNORECASE"]),
    ("home", r"^https?://(?:www\.)?{host}/?$", ["IGNORECASE"]),
]

# --- fixed values: the closed label set of the relabel step, in this order.
TAXONOMY = [
    "product", "campaign", "brand", "seller_store", "policy", "search_results",
    "blog_article", "help_center", "login", "cart_or_checkout", "homepage",
    "about_or_contact", "other",
]

# --- fixed values: default link column map (output column -> source field)
# and the default key and batch sizes of the writers and the relabeller.
DEFAULT_COLUMN_MAP = [
    ("url", "url"),
    ("normalized_url", "normalized_url"),
    ("anchor_text", "anchor_text"),
    ("rel", "rel"),
    ("is_external", "is_external"),
    ("discovered_at", "discovered_at"),
]
DEFAULT_UNIQUE_KEY = "normalized_url"
RELABEL_BATCH_SIZE = 100
RELABEL_MAX_BATCHES = 0
RESIDUE_PREDICATE = "COALESCE(pred_category, 'other') = 'other'"

# --- fixed values: model call retry policy (tries, first wait, cap; seconds).
RETRY_TRIES = 6
RETRY_FIRST_WAIT = 1.0
RETRY_MAX_WAIT = 30.0


def rule_pack(host: str = DEFAULT_ROOT_DOMAIN) -> list[tuple[str, str, list[str]]]:
    """The rule pack with its host filled in (regex-escaped)."""
    h = re.escape(host)
    return [(label, pat.replace("{host}", h), list(flags)) for label, pat, flags in RULE_PACK]
