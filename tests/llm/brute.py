"""Plain one-text-at-a-time versions of the operators, for comparison."""

import re

PII = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
       ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(digits[::-1])]
    return sum(sum(divmod(x, 10)) for x in doubled) % 10 == 0


def pii_base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PII):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                    "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]
            if good():
                out.append((rank, m.start(), m.end()))
    return out
