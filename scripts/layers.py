"""Layer steps for spark-submit; see tierline/__main__.py."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tierline.__main__ import main  # noqa: E402

if __name__ == "__main__":
    for key, table in main(sys.argv[1:]).items():
        print(f"{key}\t{table}")
