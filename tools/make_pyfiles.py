"""Build ``quire.zip`` for ``spark-submit --py-files`` (cluster deployment).

Usage: python tools/make_pyfiles.py [out.zip]
"""

from __future__ import annotations

import os
import sys
import zipfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    out = sys.argv[1] if len(sys.argv) > 1 else "quire.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(os.path.join(ROOT, "quire")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, ROOT))
    print(out)


if __name__ == "__main__":
    main()
