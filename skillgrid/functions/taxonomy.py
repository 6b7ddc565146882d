"""Skill taxonomy: an ordered list of regex aliases per skill.

The first alias (lowest ``pattern_order``) that matches a text is the one a
skill reports. The patterns are written in the Python ``re`` dialect; the
RE2-dialect variants of the three lookaround aliases are listed separately.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- Fixed values: must equal the original taxonomy for identical results. ---
# 66 skills, 124 aliases, in taxonomy order; alias order inside a skill is
# pattern_order 0, 1, 2, ...
TECH_SKILLS: dict[str, list[str]] = {
    "python": [r"\bpython\b"],
    "r": [r"\br[-\s]?programmering\b", r"\br programming\b", r"\br language\b"],
    "sql": [r"\bsql\b", r"\bt[-\s]?sql\b", r"\bpl/sql\b"],
    "postgresql": [r"\bpostgres\b", r"\bpostgresql\b"],
    "mysql": [r"\bmysql\b"],
    "sql_server": [r"\bsql server\b", r"\bmicrosoft sql\b"],
    "oracle": [r"\boracle\b"],
    "mongodb": [r"\bmongodb\b", r"\bmongo db\b"],
    "redis": [r"\bredis\b"],
    "elasticsearch": [r"\belasticsearch\b", r"\belastic search\b"],
    "aws": [r"\baws\b", r"\bamazon web services\b"],
    "azure": [r"\bazure\b", r"\bmicrosoft azure\b"],
    "gcp": [r"\bgcp\b", r"\bgoogle cloud\b", r"\bgoogle cloud platform\b"],
    "azure_data_factory": [r"\bazure data factory\b", r"\badf\b"],
    "azure_synapse": [r"\bazure synapse\b", r"\bsynapse analytics\b"],
    "bigquery": [r"\bbigquery\b", r"\bbig query\b"],
    "redshift": [r"\bredshift\b", r"\bamazon redshift\b"],
    "docker": [r"\bdocker\b"],
    "kubernetes": [r"\bkubernetes\b", r"\bk8s\b"],
    "terraform": [r"\bterraform\b"],
    "ansible": [r"\bansible\b"],
    "jenkins": [r"\bjenkins\b"],
    "github_actions": [r"\bgithub actions\b"],
    "devops": [r"\bdevops\b"],
    "spark": [r"\bspark\b", r"\bapache spark\b", r"\bpyspark\b"],
    "databricks": [r"\bdatabricks\b"],
    "airflow": [r"\bairflow\b", r"\bapache airflow\b"],
    "dbt": [r"\bdbt\b", r"\bdata build tool\b"],
    "snowflake": [r"\bsnowflake\b"],
    "kafka": [r"\bkafka\b", r"\bapache kafka\b"],
    "flink": [r"\bflink\b", r"\bapache flink\b"],
    "hadoop": [r"\bhadoop\b"],
    "data_engineering": [
        r"\bdata engineering\b",
        r"\bdata engineer\b",
        r"\bdataingenjor\b",
        r"\bdataingenjör\b",
    ],
    "power_bi": [r"\bpower\s?bi\b", r"\bpowerbi\b", r"\bpower bi desktop\b"],
    "tableau": [r"\btableau\b"],
    "qlik": [r"\bqlik\b", r"\bqlikview\b", r"\bqlik sense\b"],
    "looker": [r"\blooker\b", r"\blooker studio\b"],
    "excel": [r"\bexcel\b", r"\bmicrosoft excel\b"],
    "git": [r"\bgit\b"],
    "github": [r"\bgithub\b"],
    "gitlab": [r"\bgitlab\b"],
    "javascript": [r"\bjavascript\b", r"\bjava script\b"],
    "typescript": [r"\btypescript\b", r"\btype script\b"],
    "java": [r"\bjava\b"],
    "csharp": [r"(?<!\w)c#(?!\w)", r"\bcsharp\b", r"\bc sharp\b"],
    "cpp": [r"(?<!\w)c\+\+(?!\w)"],
    "dotnet": [r"(?<!\w)\.net\b", r"\bdotnet\b", r"\basp\.net\b"],
    "nodejs": [r"\bnode\.?js\b", r"\bnode js\b"],
    "react": [r"\breact\b", r"\breact\.js\b"],
    "angular": [r"\bangular\b"],
    "vue": [r"\bvue\b", r"\bvue\.js\b"],
    "go": [r"\bgolang\b", r"\bgo programming\b"],
    "rust": [r"\brust\b"],
    "scala": [r"\bscala\b"],
    "pandas": [r"\bpandas\b"],
    "numpy": [r"\bnumpy\b"],
    "scikit_learn": [r"\bscikit[\-\s]?learn\b", r"\bsklearn\b"],
    "tensorflow": [r"\btensorflow\b"],
    "pytorch": [r"\bpytorch\b", r"\bpy torch\b"],
    "machine_learning": [
        r"\bmachine learning\b",
        r"\bmaskininlarning\b",
        r"\bmaskininlärning\b",
    ],
    "ai": [
        r"\bai engineer\b",
        r"\bai model\b",
        r"\bai models\b",
        r"\bartificial intelligence\b",
        r"\bartificiell intelligens\b",
    ],
    "llm": [
        r"\bllm\b",
        r"\bllms\b",
        r"\blarge language model\b",
        r"\blarge language models\b",
    ],
    "openai": [r"\bopenai\b", r"\bazure openai\b"],
    "langchain": [r"\blangchain\b"],
    "rag": [r"\brag\b", r"\bretrieval augmented generation\b"],
    "nlp": [
        r"\bnlp\b",
        r"\bnatural language processing\b",
        r"\bsprakbehandling\b",
        r"\bspråkbehandling\b",
    ],
}

# --- Fixed values: RE2 has no lookarounds, so these three aliases are run in
# the SQL (RE2) dialect as forms that consume the neighbouring character. ---
RE2_PATTERN_OVERRIDES: dict[str, str] = {
    r"(?<!\w)c#(?!\w)": r"(^|[^[:alnum:]_])c#([^[:alnum:]_]|$)",
    r"(?<!\w)c\+\+(?!\w)": r"(^|[^[:alnum:]_])c\+\+([^[:alnum:]_]|$)",
    r"(?<!\w)\.net\b": r"(^|[^[:alnum:]_])\.net\b",
}

PATTERN_SCHEMA = T.StructType(
    [
        T.StructField("skill", T.StringType(), False),
        T.StructField("pattern_order", T.IntegerType(), False),
        T.StructField("pattern", T.StringType(), False),
    ]
)


def pattern_rows(
    taxonomy: dict[str, list[str]] | None = None, dialect: str = "re2"
) -> list[tuple[str, int, str]]:
    """Flatten a taxonomy to ``(skill, pattern_order, pattern)`` rows.

    ``dialect="re2"`` applies the RE2 overrides (what the SQL build runs);
    ``dialect="python"`` keeps the patterns as written.
    """
    taxonomy = TECH_SKILLS if taxonomy is None else taxonomy
    rows = []
    for skill, patterns in taxonomy.items():
        for order, pattern in enumerate(patterns):
            if dialect == "re2":
                pattern = RE2_PATTERN_OVERRIDES.get(pattern, pattern)
            rows.append((skill, order, pattern))
    return rows


def surface_form(pattern: str) -> str:
    """A short text the pattern matches: optional parts once, the first of every choice."""
    from re import _constants as op
    from re import _parser

    def text(parts) -> str:
        out = []
        for kind, value in parts:
            if kind is op.LITERAL:
                out.append(chr(value))
            elif kind is op.IN:
                first, what = value[0]
                out.append(" " if first is op.CATEGORY else chr(what if first is op.LITERAL else what[0]))
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
                out.append(text(value[2]) * max(1, value[0]))
            elif kind is op.SUBPATTERN:
                out.append(text(value[-1]))
            elif kind is op.BRANCH:
                out.append(text(value[1][0]))
            elif kind not in (op.AT, op.ASSERT, op.ASSERT_NOT):
                raise ValueError(f"no surface form for {kind} in {pattern!r}")
        return "".join(out)

    return text(_parser.parse(pattern))


def taxonomy_frame(
    spark: SparkSession,
    taxonomy: dict[str, list[str]] | None = None,
    dialect: str = "re2",
) -> DataFrame:
    """The taxonomy as a small ``patterns(skill, pattern_order, pattern)`` relation."""
    return spark.createDataFrame(pattern_rows(taxonomy, dialect), PATTERN_SCHEMA)
