"""Connectors: how a source's lines are parsed, classified and watched, as plain data."""

from __future__ import annotations

import json
from collections import deque
from dataclasses import asdict, dataclass, field


# Fixed values that every fact carries: its stamp, and the version of the rules' semantics.
LEGAL_STAMP = "icp_brasil_serpro_tst_recibo"
REASONING_VERSION = "reasoner-core-v6.0"


@dataclass(frozen=True)
class Condition:
    """One test on a token; only the first operator set, in this order, counts; none set is true."""

    field: str = ""
    matches: str | None = None
    equals: str | None = None
    contains: str | None = None
    among: tuple[str, ...] | None = None
    severity_in: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Rule:
    id: str
    when: tuple[Condition, ...] = ()
    action: str = "log.info"
    behavior_class: str = "observation"
    risk: str = "Low"
    actor: str | None = "${user}"
    target: str | None = None
    source_ip: str | None = "${ip}"


@dataclass(frozen=True)
class Signature:
    id: str
    action: str
    window_secs: int
    threshold: int
    behavior_class: str
    risk: str


@dataclass(frozen=True)
class Connector:
    name: str
    confidence: float
    pattern: str | None
    rules: tuple[Rule, ...]
    signatures: tuple[Signature, ...]
    steps: tuple[tuple[str, tuple[str, ...]], ...] = (("parse", ()), ("normalize", ("parse",)), ("behavior", ("normalize",)), ("emit", ("behavior",)))
    cases: tuple[tuple[str, str], ...] = field(default=())
    ontology_version: str = "v9"

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Connector:
        d = json.loads(text)
        tup = lambda x: None if x is None else tuple(x)
        rules = tuple(Rule(**{**r, "when": tuple(Condition(**{**c, "among": tup(c["among"]), "severity_in": tup(c["severity_in"])}) for c in r["when"])}) for r in d["rules"])
        return Connector(d["name"], d["confidence"], d["pattern"], rules, tuple(Signature(**s) for s in d["signatures"]), tuple((n, tuple(x)) for n, x in d["steps"]), tuple(map(tuple, d["cases"])), d["ontology_version"])


def execution_order(steps: tuple[tuple[str, tuple[str, ...]], ...]) -> list[str]:
    """Steps in dependency order, first in first out from names in order; cycles and strangers are errors."""
    needs = {n: set(d) for n, d in steps}
    for n, d in needs.items():
        if strange := d - needs.keys():
            raise ValueError(f"{n} depends on unknown {sorted(strange)}")
    ready, out = deque(sorted(n for n, d in needs.items() if not d)), []
    left = {n: len(d) for n, d in needs.items()}
    while ready:
        out.append(ready.popleft())
        for n in sorted(needs):
            if out[-1] in needs[n]:
                left[n] -= 1
                if not left[n]:
                    ready.append(n)
    if len(out) < len(needs):
        raise ValueError("the steps depend on each other in a circle")
    return out


# Fixed values of the built-in connectors: patterns, names, classes, thresholds.
DATABASE = Connector(
    name="postgresql",
    confidence=0.972,
    pattern=r"^(?P<ts>\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d+)?(?: \S+)?) \[(?P<pid>\d+)\] (?:(?P<user>\w+)@(?P<db>\w+) )?(?P<severity>[A-Z]+):\s+(?P<message>.*)$",
    rules=(
        Rule("pg_auth_failure", (Condition("message", matches=r'password authentication failed for user "(?P<target_user>[^"]+)"'),), "authentication.failure", "credential_attack", "High", "${target_user}", "postgresql"),
        Rule("pg_connection_authorized", (Condition("message", matches=r"connection authorized: user=(?P<target_user>\w+)(?: database=(?P<target_db>\w+))?"),), "authentication.success", "session", "Low", "${target_user}", "${target_db}"),
        Rule("pg_permission_denied", (Condition("message", contains="permission denied"),), "authorization.failure", "privilege_violation", "Medium", "${user}", "${db}"),
        Rule("pg_statement", (Condition("message", matches=r"^statement: (?P<stmt>.+)$"),), "query.execute", "data_access", "Low", "${user}", "${db}"),
        Rule("pg_fatal", (Condition(severity_in=("FATAL", "PANIC")),), "system.fault", "availability", "High", "${user}", "${db}"),
        Rule("pg_info", (), "log.info", "observation", "Low", "${user}", "${db}"),
    ),
    signatures=(Signature("pg_brute_force", "authentication.failure", 60, 5, "brute_force_attack", "Critical"),),
    cases=(
        ('2026-06-26 01:20:05.123 UTC [14802] FATAL:  password authentication failed for user "admin"', "authentication.failure"),
        ("2026-06-26 01:20:11.500 UTC [14808] admin@prod LOG:  connection authorized: user=admin database=prod", "authentication.success"),
        ("2026-06-26 01:20:12.000 UTC [14808] admin@prod LOG:  statement: SELECT * FROM salaries;", "query.execute"),
        ("2026-06-26 01:20:13.000 UTC [14809] guest@prod ERROR:  permission denied for table salaries", "authorization.failure"),
        ("2026-06-26 01:20:00.001 UTC [14801] LOG:  database system is ready to accept connections", "log.info"),
    ),
)
SSH = Connector(
    name="linux_sshd",
    confidence=0.984,
    pattern=r"^<(?P<pri>\d+)> (?P<user>\S+) failed password for (?P<target>\S+) from (?P<ip>\S+)",
    rules=(Rule("ssh_auth_failure", (), "authentication.failure", "credential_attack", "High", "${user}", "${target}", "${ip}"),),
    signatures=(Signature("ssh_brute_force", "authentication.failure", 60, 5, "brute_force_attack", "Critical"),),
    cases=(("<13> admin failed password for root from 187.4.5.1", "authentication.failure"),),
)
KEY_VALUE = Connector(
    name="keyvalue_generic",
    confidence=0.91,
    pattern=None,
    rules=(
        Rule("kv_destructive_failure", (Condition("STATUS", equals="failed"), Condition("ACTION", matches="(delete|drop|truncate)")), "data.deletion.failure", "data_tampering", "High", "${USER}", "${TARGET}"),
        Rule("kv_default", (), "log.info", "observation", "Low", "${USER}", "${TARGET}"),
    ),
    signatures=(Signature("kv_mass_deletion", "data.deletion.failure", 120, 3, "sabotage_attempt", "Critical"),),
    cases=(("USER=carlos_mgi ACTION=delete_record TARGET=table_benefits STATUS=failed", "data.deletion.failure"),),
)
