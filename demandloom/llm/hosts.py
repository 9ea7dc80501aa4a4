"""URL filtering by rules and, where no rule fits, by the reputation of the host.

Pages that a rule decides are the labelled outcomes.  Their counts per host are shrunk through
beta-binomial priors: a suffix towards all pages, a registered domain towards its suffix, a host
towards its registered domain.  How far a level is shrunk is read off the data: the intra-class
correlation rho of the outcomes within its members gives the prior's weight 1 / rho - 1.  A host is
blocked when the lower bound of its posterior blocking rate is above one half.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, small_side, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Second-level names under which country registries hand out domains.
REGISTRY = "ac|co|com|edu|gov|net|org"
#: Posterior standard deviations between the mean and the bound, and the bound that blocks.
Z, BLOCK_ABOVE = 1.645, 0.5
#: Limits of rho: never all weight on the prior, nor none.
RHO = (0.001, 0.999)


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains and a path prefix, written as `host/path`."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label, or the last two where a country registry hands out third-level names."""
    return F.regexp_extract(host, rf"((?:(?:^|(?<=\.))(?:{REGISTRY})\.[a-z]{{2}}|[^.:]*))\.?(?::\d*)?$", 1)


def domain_of(host: Column) -> Column:
    """The suffix and one label before it."""
    bare = F.regexp_replace(host, r"\.?(:\d*)?$", "")
    return F.regexp_extract(bare, rf"((?:[^.]+\.)?(?:(?:(?<=\.)(?:{REGISTRY})\.[a-z]{{2}})|[^.]*))$", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _rho(members: DataFrame, mean: str) -> float:
    """Moment estimate of the intra-class correlation around each member's own prior mean."""
    spread = F.expr(f"{mean} * (1 - {mean})")
    row = members.agg(
        F.sum(F.pow(F.expr(f"k - n * {mean}"), 2) - F.col("n") * spread).alias("over"),
        F.sum(F.expr("n * (n - 1)") * spread).alias("most"),
    ).first()
    # Where no member has two labelled pages, nothing speaks against the prior.
    rho = row["over"] / row["most"] if row["most"] else RHO[0]
    return min(max(rho, RHO[0]), RHO[1])


def reputations(hosts: DataFrame) -> DataFrame:
    """Posterior of each row of hosts(host, domain, suffix, n, k): host, mean, bound.

    At every level the prior weighs as much as the members' agreement allows.  The bound counts it for
    no more labelled pages than stand behind it: those of the level above outside the member, with
    what stands behind that level's own prior.  So a rate that few pages make known is uncertain
    wherever it is handed down.
    """
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    # Half a page of either outcome stands for the prior of all pages.
    pages = (total["n"] or 0) + 1.0
    overall = ((total["k"] or 0) + 0.5) / pages

    def shrunk(members: DataFrame, prior: str, known: str, out: str) -> DataFrame:
        """Adds the posterior mean `out`, and `out`_pages, the labelled pages behind it."""
        weight = 1 / _rho(members, prior) - 1
        behind = F.expr(f"n + least({weight!r}D, {known} - n)")
        return members.withColumns(
            {out: F.expr(f"(k + {weight!r}D * {prior}) / (n + {weight!r}D)"), f"{out}_pages": behind}
        )

    suffixes = shrunk(
        hosts.groupBy("suffix")
        .agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        .withColumns({"m": F.lit(overall), "m_pages": F.lit(pages)}),
        "m",
        "m_pages",
        "suffix_mean",
    )
    domains = shrunk(
        hosts.groupBy("domain", "suffix")
        .agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        .join(suffixes.select("suffix", "suffix_mean", "suffix_mean_pages"), "suffix"),
        "suffix_mean",
        "suffix_mean_pages",
        "domain_mean",
    )
    own = shrunk(
        hosts.join(domains.select("domain", "domain_mean", "domain_mean_pages"), "domain"),
        "domain_mean",
        "domain_mean_pages",
        "mean",
    )
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("mean_pages") + 1))
    bound = F.greatest(F.lit(0.0), F.col("mean") - Z * deviation)
    return own.select("host", "mean", bound.alias("bound"))


def judge(
    pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, and the host's posterior mean and bound.

    A missing url, and one without `://`, has an empty host and path; such pages share one host
    that no rule fits.  Ids are only carried along, repeated rows stay, an empty table gives no
    rows, other columns are not read.  Without any labelled page everything is allowed.
    """
    found = pages.select(quoted(id_col).alias("id"), quoted(url_col).cast("string").alias("url")).select(
        "id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    found = found.withColumns({"rule": text, "rule_verdict": verdict})
    hosts = written(
        found.groupBy("host")
        .agg(F.count("rule").alias("n"), F.count_if(F.col("rule_verdict") == "block").alias("k"))
        .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}),
        "hosts",
    )
    posterior = small_side(reputations(hosts), hosts.count())
    method = F.when(F.col("bound") > BLOCK_ABOVE, "block").otherwise("allow")
    return found.join(posterior, "host", "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", method).alias("verdict"),
        F.col("mean").alias("block_rate"),
        F.col("bound").alias("block_bound"),
    )
