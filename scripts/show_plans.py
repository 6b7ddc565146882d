"""Print the executed physical plans of the headline stages (for docs/PLANS.md).

Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skillgrid.operators import extract, marts, qa  # noqa: E402
from skillgrid.plans.warehouse import warehouse  # noqa: E402
from skillgrid.session import build_session  # noqa: E402


def show(title: str, df) -> None:
    df.write.format("noop").mode("overwrite").save()
    print(f"\n### {title}\n")
    df.explain("simple")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    wh = warehouse(spark, sf_dir)
    ads = wh.ads()
    show("regex stage: extraction and one row per (id, skill)", extract.regex_skill_matches(ads))
    show("duplicate ids (narrow id-only aggregate)", extract.duplicate_ids(ads))
    show("regex matches as read by samples and QA", wh.regex_matches())
    show("trends build", marts.skill_trends(wh.monthly_counts(), wh.stg_ads(), wh.duplicate_ids()))
    show(
        "geography build",
        marts.skill_geography(
            wh.regex_skills(), wh.stg_ads(), one_row_per_id_skill=True, dup_ids=wh.duplicate_ids()
        ),
    )
    show("samples (top 20 per skill)", qa.skill_samples(wh.regex_matches()))
    spark.stop()


if __name__ == "__main__":
    main()
