"""Shell-glob patterns on command lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suspicious command lines (Sigma rule set, Detection Rule License,
# rule lnx_shell_susp_commands by Florian Roth).
SUSPICIOUS_COMMANDS = (
    "wget * - http* | perl",
    "wget * - http* | sh",
    "wget * - http* | bash",
    "python -m SimpleHTTPServer",
    "-m http.server",
    "import pty; pty.spawn*",
    "socat exec:*",
    "socat -O /tmp/*",
    "socat tcp-connect*",
    "*echo binary >>*",
    "*wget *; chmod +x*",
    "*wget *; chmod 777 *",
    "*cd /tmp || cd /var/run || cd /mnt*",
    "*stop;service iptables stop;*",
    "*stop;SuSEfirewall2 stop;*",
    "chmod 777 2020*",
    "*>>/etc/rc.local",
    "*base64 -d /tmp/*",
    "* | base64 -d *",
    "*/chmod u+s *",
    "*chmod +s /tmp/*",
    "*chmod u+s /tmp/*",
    "* /tmp/haxhax*",
    "* /tmp/ns_sploit*",
    "nc -l -p *",
    "cp /bin/ksh *",
    "cp /bin/sh *",
    "* /tmp/*.b64 *",
    "*/tmp/ysocereal.jar*",
    "*/tmp/x *",
    "*; chmod +x /tmp/*",
    "*;chmod +x /tmp/*",
    "*tweet*",
)


def published_patterns(fixed: bool = True) -> list[str]:
    """The patterns; ``fixed=False`` glues numbers 5 and 6 together as published."""
    patterns = list(SUSPICIOUS_COMMANDS)
    if not fixed:
        patterns[4:6] = [patterns[4] + patterns[5]]
    return patterns


def glob_like(pattern: str) -> str:
    r"""LIKE pattern of a glob that may start anywhere but must reach the end."""
    out = "".join({"*": "%", "?": "_", "%": r"\%", "_": r"\_", "\\": r"\\"}.get(ch, ch) for ch in pattern)
    return "%" + out.lstrip("%") if out.startswith("%") else "%" + out


def glob_score(text: Column, patterns: Sequence[str] | None = None) -> Column:
    """Number of patterns that match; 0 for NULL."""
    patterns = published_patterns() if patterns is None else patterns
    score = F.lit(0)
    for pattern in patterns:
        score = score + F.coalesce(text.like(glob_like(pattern)), F.lit(False)).cast("int")
    return score
