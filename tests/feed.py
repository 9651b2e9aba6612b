"""Hand-written pages for the tests."""

import json
from pathlib import Path

NAME = "cves_20240101_20240130_p{page:03d}_20240131T000000Z.json"


def cve(cve_id="CVE-1", published="2024-01-02T03:04:05.678", modified="2024-01-03T00:00:00.000", **fields):
    return {"cve": {"id": cve_id, "published": published, "lastModified": modified, **fields}}


def v3(score, severity="HIGH", vector=None):
    data = {"baseScore": score, "baseSeverity": severity}
    return {"cvssData": data | ({"vectorString": vector} if vector else {})}


def v2(score, severity="MEDIUM"):
    return {"baseSeverity": severity, "cvssData": {"baseScore": score}}


def text(value, lang="en"):
    return {"lang": lang, "value": value}


def weakness(*texts):
    return {"description": list(texts)}


def page(directory, number, *cves, total=None, **extra):
    path = Path(directory) / NAME.format(page=number)
    path.parent.mkdir(parents=True, exist_ok=True)
    document = {
        "resultsPerPage": len(cves),
        "startIndex": 0,
        "totalResults": len(cves) if total is None else total,
        "vulnerabilities": list(cves),
    }
    path.write_text(json.dumps(document | extra, indent=1))
    return path
