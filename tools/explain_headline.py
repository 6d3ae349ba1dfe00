"""Write ``explain("formatted")`` of the headline queries (or the given
ones) to text files in a new scratch folder and print the folder.

    python tools/explain_headline.py [sf_dir] [query ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from scorewatch.plans.catalog import QUERIES  # noqa: E402
from scorewatch.session import local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or list(HEADLINE)
    spark = local_session(8, 16)
    folder = tempfile.mkdtemp(prefix="scorewatch-plans-")
    for name in names:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf).explain("formatted")
        with open(os.path.join(folder, f"{name}.txt"), "w") as f:
            f.write(buf.getvalue())
    print(folder)


if __name__ == "__main__":
    main()
