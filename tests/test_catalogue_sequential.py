"""Order-dependent catalogue maps vs sequential models of the documented
behaviour, on random catalogues (ids repeat across groups on purpose)."""

import random

from clickfeat.operators import catalogue as cat
from conftest import ads_df


def random_rows(seed, n=80):
    r = random.Random(seed)
    rows = []
    for pos in range(n):
        g = r.randint(1, 4)
        c = f"c{r.randint(1, 6)}"
        q = r.choice(["q1", "q2", "q3", "q1 q2"])
        kw = [r.choice(["q1", "q2", "q3", "zz"]) for _ in range(r.randint(1, 3))]
        rows.append((pos, c, g, q, r.choice(["x", "y"]), kw, pos))
    return rows


def sequential_maps(rows):
    group_camp, camp_ads, group_queries, camp_cat = {}, {}, {}, {}
    for a, c, g, q, k, kw, p in rows:                      # file order
        if g in group_camp and c in group_camp[g]:
            camp_ads[c].append(a)
        else:                                              # new (group, campaign): list restarts
            group_camp.setdefault(g, set()).add(c)
            camp_ads[c] = [a]
        if g in group_queries:
            group_queries[g].add(q)
        else:                                              # first ad only creates the group
            group_queries[g] = set()
        camp_cat[c] = k
    return camp_ads, group_queries, camp_cat


def test_order_dependent_maps(spark):
    for seed in (1, 2, 3, 4):
        rows = random_rows(seed)
        df = ads_df(spark, rows)
        camp_ads, group_queries, camp_cat = sequential_maps(rows)
        got = {}
        for r in cat.campaign_ads_reset(df).collect():
            got.setdefault(r.campaign_id, []).append((r.pos, r.ad_id))
        assert {c: [a for _, a in sorted(v)] for c, v in got.items()} == camp_ads
        gq = {}
        for r in cat.group_queries_dropfirst(df).collect():
            gq.setdefault(r.query_group_id, set()).add(r.query)
        assert gq == {g: s for g, s in group_queries.items() if s}
        assert {r.campaign_id: r.category for r in cat.campaign_category(df).collect()} == camp_cat


def test_lowest_weight_pick(spark):
    for seed in (5, 6, 7, 8):
        rows = random_rows(seed, 60)
        df = ads_df(spark, rows)
        aw = {r.ad_id: r.weight for r in cat.ad_weights(df).collect()}
        cw = {(r.query_group_id, r.campaign_id): (r.weight, r.first_pos, r.n_ads)
              for r in cat.campaign_weights(df).collect()}
        want = {}
        for g in {k[0] for k in cw}:
            camps = sorted((round(w, 9), fp, c, n) for (gg, c), (w, fp, n) in cw.items() if gg == g)
            if len(camps) <= 1:
                continue
            low = [x for x in camps if x[0] < 1.0]
            if not low:
                continue
            c = low[0][2]
            if sum(r[1] == c for r in rows) <= 1:      # the campaign's own list: its ads of all groups
                continue
            ads = sorted((round(aw[r[0]], 9), r[6], r[0]) for r in rows if r[1] == c and r[0] in aw)
            ads = [x for x in ads if x[0] < 1.0]
            if ads:
                want[g] = (c, ads[0][2])
        got = {r.query_group_id: (r.campaign_id, r.ad_id) for r in cat.lowest_weight_ad(df).collect()}
        assert got == want
