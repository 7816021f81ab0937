"""Closed vocabularies and pinned identifiers, kept as data."""

from __future__ import annotations

import uuid

#: Prefix of the engine's own relationship types and properties. Set it to what consumers expect.
PREFIX = "x-sigloom"
HAS_ACCESS, VALID_ON = f"{PREFIX}-has-access", f"{PREFIX}-valids-on"
PROPERTY = PREFIX.replace("-", "_") + "_"
EXTENSION_ID = "extension-definition--5b9f3c1e-2d74-5e0a-9b36-0f4d8c7a6e21"
EXTENSION_TEXT = "Properties of bundles and node types that this engine adds; consumers without the extension can ignore them."
EXTENSION_SCHEMA, EXTENSION_VERSION = "https://example.org/schema/bundle-metadata.json", "1.0.0"
EXTENSION_PROPERTIES = tuple(PROPERTY + p for p in "source_url collected_at matched_pir_ids relevance_score relevance_rationale".split())
ASSET_NODE, IDENTITY_NODE = "x-asset-internal", "x-identity-internal"

ENTITY_TYPES = tuple(
    sorted("attack-pattern campaign identity indicator intrusion-set malware observed-data threat-actor tool user-account vulnerability".split())
)
RELATIONSHIP_TYPES = tuple(sorted(f"attributed-to exploits impersonates indicates targets uses {HAS_ACCESS} {VALID_ON}".split()))

_ACTING = "attack-pattern campaign intrusion-set malware threat-actor tool"
_ALLOWED = (
    ("uses", _ACTING, "attack-pattern infrastructure malware tool"),
    ("targets", _ACTING, "identity infrastructure location vulnerability"),
    ("exploits", "malware", "vulnerability"),
    ("indicates", "indicator", "attack-pattern campaign infrastructure intrusion-set malware threat-actor tool"),
    ("attributed-to", "campaign", "intrusion-set threat-actor"),
    ("attributed-to", "intrusion-set", "threat-actor"),
    ("attributed-to", "threat-actor", f"identity {IDENTITY_NODE}"),
    ("impersonates", "threat-actor", f"identity {IDENTITY_NODE}"),
    (HAS_ACCESS, "identity", ASSET_NODE),
    (VALID_ON, "user-account", ASSET_NODE),
)
#: Allowed (source type, relationship, target type); a relationship outside them is dropped.
TRIPLES = tuple((s, rel, t) for rel, sources, targets in _ALLOWED for s in sources.split() for t in targets.split())
#: Those that validation holds attribution and impersonation against.
ATTRIBUTION = tuple(x for x in TRIPLES if x[1] in ("attributed-to", "impersonates"))

IDENTITY_CLASSES = tuple("unknown system organization individual group class".split())
SECTORS = tuple(
    """water utilities transportation telecommunications technology retail pharmaceuticals nuclear non-profit mining manufacturing
    infrastructure hospitality-leisure healthcare government-regional government-public-services government-national government-local
    government financial-services entertainment energy emergency-services education defense dams construction communications commercial
    chemical automotive agriculture aerospace""".split()
)
TOOL_TYPES = tuple(
    """vulnerability-scanning unknown remote-access network-capture information-gathering exploitation denial-of-service
    credential-exploitation""".split()
)
MALWARE_TYPES = tuple(
    """worm wiper webshell virus unknown trojan spyware screen-capture rootkit rogue-security-software resource-exploitation
    remote-access-trojan ransomware keylogger exploit-kit dropper downloader ddos bot bootkit backdoor adware""".split()
)
MOTIVATIONS = tuple(
    "unpredictable revenge personal-satisfaction personal-gain organizational-gain notoriety ideology dominance coercion accidental".split()
)
ACCOUNT_TYPES = tuple("windows-local windows-domain unix twitter tacacs skype radius openid nis ldap kavi facebook".split())
ACCESS_LEVELS = tuple("deny admin write read".split())

TLP_LEVELS = ("clear", "green", "amber", "red")
#: Marking definitions of both protocol versions (the strict variant counts as amber).
TLP_MARKINGS = {
    f"marking-definition--{mark}": level
    for level, marks in (
        ("red", "5e57c739-391a-4eb3-b6be-7d15ca92d5ed e828b379-4e03-4974-9ac4-e53a884c97c1"),
        ("amber", "939a9414-2ddd-4d32-a0cd-375ea402b003 55d920b0-5e8b-4f79-9ee9-91f868d9b421 f88d31f6-486f-44da-b317-01333bde0b82"),
        ("green", "34098fce-860f-48ae-8e50-ebd3cc5e41da bab4a63c-aed9-4cf5-a766-dfca5abac2bb"),
        ("clear", "613f2e26-407d-48c7-9eca-b8e91df99dc9 94868c89-83c2-464b-929b-a1a8aa3c8487"),
    )
    for mark in marks.split()
}

IOC_TYPES = tuple("cve_id md5 sha1 sha256 fqdn ipv6 ipv4".split())
DECISIONS = tuple("kept no_pir extraction_failed skipped_below_threshold".split())
OUTCOMES = tuple("extracted no_objects extraction_failed fetch_failed skipped_below_threshold skipped_unchanged".split())
SEVERITIES = ("error", "warning", "info")
STOPWORDS = tuple(
    sorted("with this threat their the that targeting target risk report related monitor into from collection campaign and also against about".split())
)

#: Phrases of estimative probability, tried from the top: a phrase that holds another one comes first.
HEDGES = (
    (95, ("with certainty", "confirmed", "definitive", "almost certain")),
    (85, ("very probable", "high confidence", "highly probable", "very likely")),
    (15, ("highly improbable", "very unlikely", "highly unlikely")),
    (30, ("low confidence", "improbable", "unlikely")),
    (70, ("moderate confidence", "probable", "likely")),
    (5, ("remote chance", "almost no chance", "no indication", "no evidence")),
    (50, ("50/50", "even chance", "we assess", "roughly even")),
)

#: Namespaces of name-based ids; the same key always gives the same id.
NS_ENTITY = uuid.UUID("a1b2c3d4-e5f6-7890-abcd-ef1234567890")
NS_ASSET = uuid.UUID("d41d8cd9-8f00-b204-e980-0998ecf8427e")
NS_IDENTITY = uuid.UUID("c4f8d2e6-9b1a-5c7d-8e3f-2a4b6d8e1c5f")
NS_ACCOUNT = uuid.UUID("e51e9d8a-3b2c-5d7f-9c4e-2b6a8f3c1d50")

SCHEMA_VERSION = "2.0.0"
OLD_SCHEMA_VERSIONS = ("1.0.0", "0.18.0", "0.17.0", "0.16.0")
