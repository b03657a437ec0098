"""DuckDB twins of the registered queries, over the driver's views.

Each query is a chain of named CTEs; ``sql(name)`` pulls in exactly the CTEs
it needs, in dependency order. Parameters are inlined from ``Params``.
"""

from __future__ import annotations

import re

from ..functions.columns import TAG_STOP_PATTERN, epoch_seconds
from ..params import DEFAULT, EXPORT_ROWS, Params


def _defs(p: Params) -> dict[str, str]:
    before_cf = p.day_before(p.days_cf)
    before_prof = p.datetime_before(p.days_profile)
    since_hist = p.day_before(p.days_history)
    since_hot = p.day_before(p.days_hot)
    since_als = p.day_before(p.days_als)
    cut30 = p.day_before(30)
    now = epoch_seconds(p.as_of)
    L, N, K = p.list_size_sim, p.n_theme_per_user, p.max_theme_per_tag

    def act(c, s, d):
        return f"(CASE {c} WHEN 'Scan' THEN {s:.1f}e0 WHEN 'Download' THEN {d:.1f}e0 ELSE 0.0e0 END)"

    def age(c, fallback, lenient=False):
        ts = f"try_strptime({c}, '%Y-%m-%d %H:%M:%S')"
        if lenient:
            ts = f"coalesce({ts}, try_strptime(substr({c}, 1, 10), '%Y-%m-%d'))"
        return (f"(CASE WHEN {ts} IS NULL THEN {fallback}::BIGINT "
                f"ELSE ({now}::BIGINT - epoch({ts})::BIGINT) // 86400 END)")

    def jsplit(c, sep):
        st = f"regexp_replace({c}, '(?:{sep})+$', '')"
        return (f"(CASE WHEN {c} = '' THEN [''] WHEN {st} = '' THEN []::VARCHAR[] "
                f"ELSE string_split_regex({st}, '{sep}') END)")

    tokens = (f"list_filter({jsplit('tags', '[,，]')}, "
              f"lambda t: NOT regexp_full_match(t, '{TAG_STOP_PATTERN}'))")

    def tags_expr():
        return ("CASE WHEN p_partkey % 11 = 0 THEN p_type "
                "WHEN p_partkey % 7 = 0 THEN replace(p_name, ' ', ',') || '，其他,' || p_type "
                "WHEN p_partkey % 13 = 0 THEN replace(p_name, ' ', ',') || ',,' || p_type || ',。' "
                "ELSE replace(p_name, ' ', ',') || ',' || p_type END")

    def parse(src):
        a = jsplit("value", "\t").replace("'\t'", "chr(9)")
        return (f"SELECT a[1] AS id, a[2] AS is_share, a[3] AS status, a[4] AS uid, a[5] AS grade, "
                f"a[6] AS quality, a[7] AS ctime, a[8] AS tags FROM (SELECT {a} AS a FROM {src}) "
                f"WHERE a[1] IS NOT NULL AND a[1] <> ''")

    def enrich(src, col="theme_id"):
        return (f"SELECT s.*, coalesce(c.quality, '0') AS quality, coalesce(c.grade, '3') AS grade, "
                f"coalesce(c.ctime, '1514796503') AS ctime FROM {src} s LEFT JOIN catalog c ON s.{col} = c.id")

    def history(src, cat):
        return (f"SELECT user_id, CASE WHEN grade = '4' THEN 'good' ELSE 'bad' END AS bucket, theme_id, "
                f"quality, grade, ctime FROM ({enrich(src).replace('catalog c', cat + ' c')})")

    def normalize(src, key, item, w):
        return (f"SELECT *, CASE WHEN n_ = 1 THEN 1.0e0 WHEN n_ = 2 THEN CASE WHEN rn_ = 1 THEN 1.0e0 ELSE 0.1e0 END "
                f"WHEN mx_ = mn_ THEN 1.0e0 ELSE 0.1e0 + 0.9e0 * (w9_ - mn_) / (mx_ - mn_) END AS nw_ FROM ("
                f"SELECT *, round({w}, 9) AS w9_, count(*) OVER (PARTITION BY {key}) AS n_, "
                f"max(round({w}, 9)) OVER (PARTITION BY {key}) AS mx_, min(round({w}, 9)) OVER (PARTITION BY {key}) AS mn_, "
                f"row_number() OVER (PARTITION BY {key} ORDER BY round({w}, 9) DESC, {item} ASC) AS rn_ FROM {src})")

    def ne(c):
        return f"{c} IS NOT NULL AND {c} <> ''"

    def cf_block(prefix, beh, before):
        return {
            f"{prefix}cfw": f"SELECT DISTINCT user_id, act_type, theme_id FROM {beh} WHERE pt > '{before}' AND {ne('user_id')} AND {ne('theme_id')}",
            f"{prefix}norm": f"SELECT user_id, act_type, count(*) AS n FROM {prefix}cfw GROUP BY user_id, act_type",
            f"{prefix}heat": f"SELECT theme_id, act_type, count(*) AS heat FROM {prefix}cfw GROUP BY theme_id, act_type HAVING count(*) > 1",
            f"{prefix}capped": (f"SELECT p.theme_id, p.act_type, p.user_id, h.heat FROM (SELECT theme_id, act_type, user_id FROM ("
                                f"SELECT *, row_number() OVER (PARTITION BY theme_id, act_type ORDER BY md5(concat_ws('#', theme_id, user_id, '{p.seed}')), user_id) AS pick "
                                f"FROM {prefix}cfw) WHERE pick <= {p.cap_sample}) p JOIN {prefix}heat h ON p.theme_id = h.theme_id AND p.act_type = h.act_type"),
            f"{prefix}members": (f"SELECT r.theme_id, r.act_type, r.user_id, h.heat FROM {prefix}cfw r JOIN {prefix}heat h "
                                 "ON r.theme_id = h.theme_id AND r.act_type = h.act_type"),
            f"{prefix}half": (f"SELECT a.user_id AS ua, b.user_id AS ub, a.theme_id, a.act_type, "
                              f"{act('a.act_type', p.scan_factor, p.download_factor)} / ln(1.0e0 + a.heat::DOUBLE) / sqrt(a.n::DOUBLE * b.n::DOUBLE) AS contrib "
                              f"FROM (SELECT c.*, n.n FROM {prefix}members c JOIN {prefix}norm n ON c.user_id = n.user_id AND c.act_type = n.act_type) a "
                              f"JOIN (SELECT c.*, n.n FROM {prefix}members c JOIN {prefix}norm n ON c.user_id = n.user_id AND c.act_type = n.act_type) b "
                              f"ON a.theme_id = b.theme_id AND a.act_type = b.act_type AND a.user_id < b.user_id"
                              + ("" if not p.drop_zero else f" WHERE {act('a.act_type', p.scan_factor, p.download_factor)} <> 0")),
            f"{prefix}sums": f"SELECT ua, ub, sum(contrib) AS sim FROM {prefix}half GROUP BY ua, ub",
            f"{prefix}sim": (f"SELECT user_id, neighbor, rank, round(sim, 6) AS sim FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(sim, 9) DESC, neighbor ASC) AS rank FROM ("
                             f"SELECT ua AS user_id, ub AS neighbor, sim FROM {prefix}sums UNION ALL SELECT ub, ua, sim FROM {prefix}sums)) WHERE rank <= {p.n_sim_users}"),
        }

    d = {
        "behavior": ("SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS time, CAST(l_partkey AS VARCHAR) AS theme_id, "
                     "CAST(o_custkey AS VARCHAR) AS user_id, CASE l_returnflag WHEN 'R' THEN 'Download' WHEN 'A' THEN 'Scan' ELSE 'Other' END AS act_type, "
                     "strftime(o_orderdate, '%Y-%m-%d') AS pt FROM orders JOIN lineitem ON o_orderkey = l_orderkey"),
        "ebehavior": ("SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, json_extract_string(props, '$.k') AS theme_id, "
                      "CAST(user_id AS VARCHAR) AS user_id, CASE event_type WHEN 'view' THEN 'Scan' WHEN 'purchase' THEN 'Download' ELSE 'Other' END AS act_type, "
                      "strftime(ts, '%Y-%m-%d') AS pt FROM events"),
        "catalog_lines": ("SELECT array_to_string(list_slice([CAST(p_partkey AS VARCHAR), '1', '1', p_brand, CAST(p_size % 5 AS VARCHAR), "
                          "CAST(p_partkey % 2 AS VARCHAR), CAST(1500000000 + p_partkey * 60 AS VARCHAR), " + tags_expr() + "], 1, "
                          "CASE WHEN p_size <= 5 THEN 7 WHEN p_size > 45 THEN 5 ELSE 8 END), chr(9)) AS value FROM part"),
        "catalog": parse("catalog_lines"),
        "new_lines": ("SELECT array_to_string(list_slice([CAST(p_partkey AS VARCHAR), '1', '1', p_brand, CAST((p_size + 1) % 5 AS VARCHAR), "
                      "CAST(p_size % 2 AS VARCHAR), CAST(1500000000 + p_partkey * 60 + 7 AS VARCHAR), p_type], 1, "
                      "CASE WHEN p_size < 25 THEN 6 ELSE 8 END), chr(9)) AS value FROM part "
                      "UNION ALL SELECT concat_ws(chr(9), CAST(p_partkey + 1000000 AS VARCHAR), '1', '1', p_brand, CAST(p_size % 5 AS VARCHAR), "
                      "CAST(p_partkey % 2 AS VARCHAR), CAST(1500000000 + p_partkey * 60 AS VARCHAR), " + tags_expr() + ") FROM part WHERE p_brand = 'Brand#1' "
                      "UNION ALL SELECT concat_ws(chr(9), CAST(p_partkey AS VARCHAR), '1', '1', p_brand, '4', '', "
                      "CAST(1500000000 + p_partkey * 60 AS VARCHAR), p_type) FROM part WHERE p_brand = 'Brand#2'"),
        "new_batch": ("SELECT id, max(is_share) AS is_share, max(status) AS status, max(uid) AS uid, max(grade) AS grade, "
                      "max(quality) AS quality, max(ctime) AS ctime, max(tags) AS tags FROM (" + parse("new_lines") + ") GROUP BY id"),
        "upserted": ("SELECT coalesce(n.id, o.id) AS id, coalesce(n.is_share, o.is_share) AS is_share, coalesce(n.status, o.status) AS status, "
                     "coalesce(n.uid, o.uid) AS uid, coalesce(n.grade, o.grade) AS grade, coalesce(n.quality, o.quality) AS quality, "
                     "coalesce(n.ctime, o.ctime) AS ctime, coalesce(n.tags, o.tags) AS tags FROM catalog o FULL OUTER JOIN new_batch n ON o.id = n.id"),
        "dl_hist": f"SELECT theme_id, user_id FROM behavior WHERE pt >= '{since_hist}' AND act_type = 'Download' AND {ne('theme_id')}",
        "dl_hot": f"SELECT theme_id, user_id FROM behavior WHERE pt >= '{since_hot}' AND act_type = 'Download' AND {ne('theme_id')}",
        "ut": f"SELECT DISTINCT user_id, theme_id FROM dl_hist WHERE {ne('user_id')} AND {ne('theme_id')}",
        "history": history("ut", "catalog"),
        "old_ut": (f"SELECT DISTINCT user_id, theme_id FROM behavior WHERE pt < '{cut30}' AND pt >= '{since_hist}' AND act_type = 'Download' "
                   f"AND {ne('theme_id')} AND {ne('user_id')}"),
        "new_ut": (f"SELECT DISTINCT user_id, theme_id FROM behavior WHERE pt >= '{cut30}' AND pt >= '{since_hist}' AND act_type = 'Download' "
                   f"AND {ne('theme_id')} AND {ne('user_id')}"),
        "hist_merged": (f"SELECT DISTINCT * FROM ({history('old_ut', 'catalog')} UNION ALL {history('new_ut', 'upserted')}) WHERE {ne('user_id')}"),
        "hot": (f"SELECT rank, theme_id AS id, dn, grade, quality, ctime FROM (SELECT *, row_number() OVER (ORDER BY quality DESC, dn DESC, ctime DESC, theme_id DESC) - 1 AS rank "
                f"FROM ({enrich('(SELECT theme_id, count(*) AS dn FROM dl_hot GROUP BY theme_id)')})) WHERE rank < {p.n_hot}"),
        **cf_block("", "behavior", before_cf),
        **cf_block("e_", "ebehavior", p.with_(as_of="2024-01-31").day_before(p.days_cf)),
        "first_seen": ("SELECT s.user_id, g.theme_id, g.quality, g.grade, g.ctime, min(s.rank) AS first_rank FROM sim s JOIN "
                       "(SELECT * FROM history WHERE bucket = 'good') g ON s.neighbor = g.user_id "
                       f"WHERE {ne('s.user_id')} AND {ne('s.neighbor')} GROUP BY s.user_id, g.theme_id, g.quality, g.grade, g.ctime"),
        "cand": ("SELECT f.user_id, f.theme_id, f.quality, f.grade, f.ctime, f.first_rank FROM first_seen f JOIN ("
                 "SELECT user_id, first_rank FROM (SELECT *, coalesce(sum(new_n) OVER (PARTITION BY user_id ORDER BY first_rank "
                 "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT user_id, first_rank, count(*) AS new_n "
                 f"FROM first_seen GROUP BY user_id, first_rank)) WHERE before < {p.max_theme_from_sim}) r "
                 "ON f.user_id = r.user_id AND f.first_rank = r.first_rank"),
        "unseen": ("SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.user_id = c.user_id AND h.theme_id = c.theme_id)"),
        "ranked": (f"SELECT * FROM (SELECT user_id, theme_id, quality, ctime, row_number() OVER (PARTITION BY user_id "
                   f"ORDER BY quality DESC, ctime DESC, theme_id ASC) AS sub FROM unseen) WHERE sub <= {L}"),
        "lack": (f"SELECT s.user_id, {L} - coalesce(c.c, 0) AS lack, coalesce(c.c, 0) AS c FROM (SELECT DISTINCT user_id FROM sim) s "
                 "LEFT JOIN (SELECT user_id, count(*) AS c FROM ranked GROUP BY user_id) c ON s.user_id = c.user_id"),
        "nb_list": ("SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY section, sub) AS pos, theme_id, section FROM ("
                    "SELECT r.user_id, r.theme_id, CASE WHEN u.lack > 0 AND r.quality <> '1' THEN 2 ELSE 0 END AS section, r.sub "
                    "FROM ranked r JOIN lack u ON r.user_id = u.user_id "
                    "UNION ALL SELECT x.user_id, h.id AS theme_id, 1 AS section, h.rank AS sub FROM ("
                    "SELECT user_id, unnest(range(0, lack)) AS hr FROM lack WHERE lack > 0) x JOIN hot h ON h.rank = x.hr)"),
        # E2
        "theme_tokens": (f"SELECT id AS theme_id, uid AS author, grade, quality, ctime, {tokens} AS tokens FROM catalog "
                         "WHERE id IS NOT NULL AND uid IS NOT NULL AND grade IS NOT NULL AND quality IS NOT NULL "
                         "AND ctime IS NOT NULL AND tags IS NOT NULL"),
        "multi": "SELECT * FROM theme_tokens WHERE len(tokens) > 1",
        "tt_pairs": "SELECT DISTINCT theme_id, author, tag FROM (SELECT theme_id, author, unnest(tokens) AS tag FROM multi)",
        "features": ("SELECT p.theme_id, p.author, a.author_n, p.tag, t.tag_n FROM tt_pairs p "
                     "JOIN (SELECT author, count(*) AS author_n FROM (SELECT DISTINCT author, theme_id FROM multi) GROUP BY author) a ON p.author = a.author "
                     "JOIN (SELECT tag, count(*) AS tag_n FROM (SELECT DISTINCT tag, theme_id FROM tt_pairs) GROUP BY tag) t ON p.tag = t.tag"),
        "st_sums": ("SELECT a.tag AS t1, b.tag AS t2, sum(1.0e0 / (1.0e0 + log10(a.author_n::DOUBLE)) / sqrt(a.tag_n::DOUBLE * b.tag_n::DOUBLE)) AS sim "
                    "FROM features a JOIN features b ON a.theme_id = b.theme_id AND a.tag < b.tag GROUP BY a.tag, b.tag"),
        "simtags": ("SELECT tag, sim_tag, rank, round(sim, 6) AS raw, round(nw_, 6) AS weight FROM (" +
                    normalize(f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY round(sim, 9) DESC, sim_tag ASC) AS rank FROM ("
                              f"SELECT t1 AS tag, t2 AS sim_tag, sim FROM st_sums UNION ALL SELECT t2, t1, sim FROM st_sums)) WHERE rank <= {p.max_similar_tag})",
                              "tag", "sim_tag", "sim") + ")"),
        "recall": (f"SELECT tag, rank, theme_id, grade, quality, ctime, tokens FROM (SELECT *, row_number() OVER (PARTITION BY tag "
                   f"ORDER BY grade DESC, quality DESC, ctime DESC, theme_id ASC) AS rank FROM (SELECT DISTINCT tag, theme_id, grade, quality, ctime, tokens FROM ("
                   f"SELECT unnest(tokens) AS tag, theme_id, grade, quality, ctime, tokens FROM theme_tokens))) WHERE rank <= {K}"),
        "idx": "SELECT DISTINCT s.tag FROM simtags s JOIN (SELECT DISTINCT tag FROM recall) r ON s.tag = r.tag",
        "ls": "SELECT * FROM recall WHERE tag IN (SELECT tag FROM idx)",
        "tg": "SELECT * FROM simtags WHERE tag IN (SELECT tag FROM idx)",
        "pbeh": (f"SELECT DISTINCT user_id, act_type, time, theme_id FROM behavior WHERE pt > '{before_prof}' AND {ne('user_id')} AND {ne('theme_id')}"),
        "rec": ("SELECT r.*, n.record_n FROM (SELECT user_id, act_type, time, sig, min(theme_id) AS rep_theme FROM pbeh JOIN "
                "(SELECT theme_id, string_agg(DISTINCT tag, ',' ORDER BY tag) AS sig FROM features GROUP BY theme_id) s USING (theme_id) "
                "GROUP BY user_id, act_type, time, sig) r JOIN (SELECT user_id, count(*) AS record_n FROM (SELECT DISTINCT user_id, act_type, time, sig FROM pbeh "
                "JOIN (SELECT theme_id, string_agg(DISTINCT tag, ',' ORDER BY tag) AS sig FROM features GROUP BY theme_id) s2 USING (theme_id)) GROUP BY user_id) n "
                "ON r.user_id = n.user_id"),
        "pw": (f"SELECT r.user_id, f.tag, sum({act('r.act_type', p.scan_factor, p.download_factor)} * "
               f"(1.0e0 / (1.0e0 + {p.time_decay}e0 * {age('r.time', p.days_profile)})) * "
               f"(1.0e0 / (1.0e0 + {p.contingency}e0 * (CASE WHEN f.tag_n // r.record_n > 1 THEN log10((f.tag_n // r.record_n)::DOUBLE) ELSE 0.0e0 END)))) AS raw "
               "FROM rec r JOIN features f ON f.theme_id = r.rep_theme GROUP BY r.user_id, f.tag"),
        "profile": ("SELECT user_id, tag, rank, round(raw, 6) AS raw, round(nw_, 6) AS weight FROM (" +
                    normalize(f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(raw, 9) DESC, tag ASC) AS rank FROM pw) "
                              f"WHERE rank <= {p.max_profile_tag})", "user_id", "tag", "raw") + ")"),
        "orig": f"SELECT user_id, tag, weight FROM profile WHERE {ne('tag')} AND tag IN (SELECT tag FROM idx)",
        "precall": f"SELECT DISTINCT o.user_id, l.theme_id FROM orig o JOIN ls l ON o.tag = l.tag WHERE {ne('o.tag')}",
        "f0": ("SELECT o.user_id, t.sim_tag AS tag, sum(o.weight * t.weight) AS weight FROM orig o JOIN tg t ON o.tag = t.tag "
               f"WHERE {ne('o.tag')} GROUP BY o.user_id, t.sim_tag"),
        "out0": ("SELECT user_id, theme_id, 0 AS hop FROM precall c WHERE NOT EXISTS (SELECT 1 FROM history h "
                 "WHERE h.user_id = c.user_id AND h.theme_id = c.theme_id)"),
    }
    # The frontier of a user depends on the frontier before it alone, so
    # its whole chain is a recursion over one row per (user, hop); it ends
    # under the weight threshold or where a set of tags comes back. The count
    # of themes then says up to which hop a user was active.
    d["fr"] = ("SELECT user_id, 1 AS hop, list(tag ORDER BY tag) AS tags, list(weight ORDER BY tag) AS ws, "
               "[array_to_string(list(tag ORDER BY tag), chr(1))] AS seen FROM f0 GROUP BY user_id "
               "UNION ALL SELECT user_id, hop + 1, tags, ws, list_append(seen, array_to_string(tags, chr(1))) FROM ("
               "SELECT user_id, hop, seen, list(tag ORDER BY tag) AS tags, list(weight ORDER BY tag) AS ws FROM ("
               "SELECT e.user_id, e.hop, e.seen, t.sim_tag AS tag, sum(e.w * t.weight) AS weight FROM ("
               "SELECT user_id, hop, seen, tags, unnest(tags) AS tag, unnest(ws) AS w FROM fr "
               f"WHERE round(list_max(ws), 9) >= {p.min_profile_weight}e0) e JOIN tg t ON e.tag = t.tag "
               f"WHERE {ne('e.tag')} AND NOT list_contains(e.tags, t.sim_tag) "
               "GROUP BY e.user_id, e.hop, e.seen, t.sim_tag) GROUP BY user_id, hop, seen) "
               "WHERE NOT list_contains(seen, array_to_string(tags, chr(1)))")
    d["hops"] = ("SELECT c.user_id, c.theme_id, min(c.hop) AS hop FROM (SELECT user_id, theme_id, 0 AS hop FROM precall "
                 "UNION ALL SELECT DISTINCT f.user_id, l.theme_id, f.hop FROM (SELECT user_id, hop, unnest(tags) AS tag FROM fr "
                 f"WHERE round(list_max(ws), 9) >= {p.min_profile_weight}e0) f JOIN ls l ON f.tag = l.tag WHERE {ne('f.tag')}) c "
                 "WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.user_id = c.user_id AND h.theme_id = c.theme_id) "
                 "GROUP BY c.user_id, c.theme_id")
    d["expanded"] = ("SELECT h.user_id, h.theme_id, h.hop::BIGINT AS hop FROM hops h LEFT JOIN (SELECT user_id, hop, "
                     "sum(count(*)) OVER (PARTITION BY user_id ORDER BY hop) AS c FROM hops GROUP BY user_id, hop) n "
                     f"ON n.user_id = h.user_id AND n.hop < h.hop GROUP BY h.user_id, h.theme_id, h.hop HAVING coalesce(max(n.c), 0) < {p.min_recall}")
    d["lists"] = (
        "SELECT user_id, 'profile' AS list, pos, theme_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
        f"ORDER BY score DESC, quality DESC, ctime DESC, theme_id ASC) AS pos FROM scored) WHERE pos <= {N} "
        "UNION ALL SELECT user_id, 'extend' AS list, pos, theme_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
        f"ORDER BY score ASC, quality ASC, ctime ASC, theme_id DESC) AS pos FROM scored) WHERE pos <= {N}")
    d["scored"] = (
        "SELECT c.user_id, c.theme_id, c.quality, c.ctime, round(coalesce(s.score, 0.0e0), 9) AS score FROM cattr c LEFT JOIN ("
        "SELECT x.user_id, x.theme_id, sum(o.weight) AS score FROM (SELECT DISTINCT user_id, theme_id, unnest(tokens) AS tag FROM cattr) x "
        "JOIN orig o ON o.user_id = x.user_id AND o.tag = x.tag GROUP BY x.user_id, x.theme_id) s "
        "ON c.user_id = s.user_id AND c.theme_id = s.theme_id")
    d["cattr"] = ("SELECT e.user_id, e.theme_id, a.quality, a.ctime, a.tokens FROM expanded e JOIN ("
                  "SELECT theme_id, any_value(quality) AS quality, any_value(ctime) AS ctime, any_value(tokens) AS tokens "
                  "FROM recall GROUP BY theme_id) a ON e.theme_id = a.theme_id")
    # E3
    d["simstr"] = "SELECT user_id, string_agg(theme_id, chr(2) ORDER BY pos) AS simuser FROM nb_list GROUP BY user_id"
    d["profstr"] = ("SELECT user_id, coalesce(string_agg(theme_id, chr(2) ORDER BY pos) FILTER (WHERE list = 'profile'), '') AS profile, "
                    "coalesce(string_agg(theme_id, chr(2) ORDER BY pos) FILTER (WHERE list = 'extend'), '') AS extend FROM lists GROUP BY user_id")
    d["dflt"] = (f"SELECT array_to_string(a[1:{L}], chr(2)) AS d_sim, array_to_string(a[{L + 1}:{L + N}], chr(2)) AS d_profile, "
                 f"array_to_string(a[{L + N + 1}:{L + 2 * N}], chr(2)) AS d_extend FROM (SELECT coalesce(list(id ORDER BY rank), []) AS a FROM hot)")
    d["merged"] = ("SELECT coalesce(p.user_id, s.user_id) AS user_id, coalesce(s.simuser, (SELECT d_sim FROM dflt)) AS simuser, "
                   "CASE WHEN p.user_id IS NULL THEN (SELECT d_profile FROM dflt) ELSE p.profile END AS profile, "
                   "CASE WHEN p.user_id IS NULL THEN (SELECT d_extend FROM dflt) ELSE p.extend END AS extend "
                   "FROM profstr p FULL OUTER JOIN simstr s ON p.user_id = s.user_id")
    pushed = ", ".join(f"('{q}')" for q in ["top", "single", "cp", "train", "topic", "simuser", "profile", "extend"])
    d["cells"] = ("SELECT user_id AS rowkey, 'pushing' AS family, 'simuser' AS qualifier, simuser AS value FROM merged "
                  "UNION ALL SELECT user_id, 'pushing', 'profile', profile FROM merged "
                  "UNION ALL SELECT user_id, 'pushing', 'extend', extend FROM merged "
                  f"UNION ALL SELECT m.user_id, 'pushed', v.q, '0' FROM merged m, (VALUES {pushed}) v(q)")
    d["exp_keyed"] = "SELECT rowkey, count(*) AS n FROM (SELECT DISTINCT rowkey, family, qualifier FROM cells) GROUP BY rowkey"
    d["exp_layout"] = (f"SELECT total, per, (files + per - 1) // per AS regions FROM (SELECT total, files, least(files, 32) AS per FROM "
                   f"(SELECT sum(n)::BIGINT AS total, greatest(1, (sum(n)::BIGINT + {EXPORT_ROWS - 1}) // {EXPORT_ROWS}) AS files FROM exp_keyed))")
    d["exp_starts"] = ("SELECT region, min(rowkey) AS start FROM (SELECT rowkey, (sum(n) OVER (ORDER BY rowkey) - n)::BIGINT * regions // total AS region "
                   "FROM exp_keyed, exp_layout) WHERE region > 0 GROUP BY region")
    d["exp_placed"] = ("SELECT k.rowkey, count(s.start) AS r FROM (SELECT rowkey FROM exp_keyed) k LEFT JOIN exp_starts s ON s.start <= k.rowkey GROUP BY k.rowkey")
    d["export"] = ("SELECT (p.r * per + (('0x' || substr(md5(c.rowkey), 1, 8))::BIGINT % per))::BIGINT AS part_id, c.rowkey, family, qualifier, "
                   "max(value) AS value FROM cells c JOIN exp_placed p ON p.rowkey = c.rowkey, exp_layout GROUP BY c.rowkey, family, qualifier, p.r, per")
    # E4
    d["ev"] = f"SELECT * FROM behavior WHERE pt > '{since_als}' AND {ne('user_id')} AND {ne('theme_id')}"
    d["uid"] = "SELECT user_id, (dense_rank() OVER (ORDER BY user_id) - 1)::INTEGER AS \"user\" FROM (SELECT DISTINCT user_id FROM ev)"
    d["iid"] = "SELECT theme_id, (dense_rank() OVER (ORDER BY theme_id) - 1)::INTEGER AS item FROM (SELECT DISTINCT theme_id FROM ev)"
    d["ratings"] = (f"SELECT u.\"user\", i.item, round({act('e.act_type', p.als_scan, p.als_download)} * "
                    f"(1.0e0 / (1.0e0 + {p.als_decay}e0 * {age('e.time', p.als_fallback_days, lenient=True)})), 9) AS rating "
                    "FROM ev e JOIN uid u ON e.user_id = u.user_id JOIN iid i ON e.theme_id = i.theme_id")
    return d


# final SELECT of each registered query
def _finals(p: Params) -> dict[str, str]:
    return {
        "behavior_window": f"SELECT time, theme_id, user_id, act_type FROM behavior WHERE pt > '{p.day_before(p.days_cf)}'",
        "download_window": "SELECT theme_id, user_id FROM dl_hist",
        "catalog_parse": "SELECT * FROM catalog",
        "catalog_upsert": "SELECT * FROM upserted",
        "catalog_cells": ("SELECT * FROM (SELECT id AS rowkey, 'a' AS family, q AS qualifier, v AS value FROM catalog "
                          "CROSS JOIN LATERAL (VALUES ('is_share', is_share), ('status', status), ('uid', uid), ('grade', grade), "
                          "('quality', quality), ('ctime', ctime), ('tags', tags)) t(q, v)) WHERE value IS NOT NULL"),
        "theme_enrich": ("SELECT s.theme_id, coalesce(c.quality, '0') AS quality, coalesce(c.grade, '3') AS grade, "
                         "coalesce(c.ctime, '1514796503') AS ctime FROM (SELECT DISTINCT theme_id FROM dl_hist) s "
                         "LEFT JOIN catalog c ON s.theme_id = c.id"),
        "user_downloads": "SELECT user_id, theme_id FROM ut",
        "good_bad": "SELECT * FROM history",
        "history_merge": "SELECT * FROM hist_merged",
        "hot_themes": "SELECT * FROM hot",
        "user_act_norm": "SELECT * FROM norm",
        "theme_heat": "SELECT * FROM heat",
        "capped_users": "SELECT * FROM capped",
        "pair_contrib": ("SELECT theme_id, act_type, count(*) AS pairs, round(sum(contrib), 6) AS contrib FROM half "
                         "GROUP BY theme_id, act_type"),
        "similar_users": "SELECT * FROM sim",
        "similar_user_map": "SELECT user_id, neighbor, sim FROM sim",
        "similar_users_events": "SELECT * FROM e_sim",
        "neighbor_candidates": "SELECT * FROM cand",
        "unseen_candidates": "SELECT * FROM unseen",
        "neighbor_list": "SELECT * FROM nb_list",
        "tag_tokens": ("SELECT theme_id, (i - 1)::BIGINT AS pos, tokens[i] AS tag FROM (SELECT theme_id, tokens, "
                       "generate_subscripts(tokens, 1) AS i FROM theme_tokens)"),
        "theme_tag_features": "SELECT * FROM features",
        "time_decay": (f"SELECT user_id, theme_id, act_type, time, age, round(1.0e0 / (1.0e0 + {p.time_decay}e0 * age), 9) AS decay FROM ("
                       f"SELECT DISTINCT user_id, theme_id, act_type, time, {_age_sql(p)} AS age FROM behavior "
                       f"WHERE pt > '{p.datetime_before(p.days_profile)}')"),
        "act_weight": (f"SELECT act_type, count(*) AS n, CASE act_type WHEN 'Scan' THEN {p.scan_factor:.1f}e0 WHEN 'Download' THEN {p.download_factor:.1f}e0 ELSE 0.0e0 END AS weight, "
                       f"CASE act_type WHEN 'Scan' THEN {p.als_scan:.1f}e0 WHEN 'Download' THEN {p.als_download:.1f}e0 ELSE 0.0e0 END AS als_weight "
                       "FROM behavior GROUP BY act_type"),
        "user_profile": "SELECT user_id, tag, weight FROM profile",
        "normalized_weights": "SELECT user_id, tag, rank, raw, weight FROM profile",
        "similar_tags": "SELECT * FROM simtags",
        "tag_recall": "SELECT tag, rank, theme_id, grade, quality, ctime FROM recall",
        "tag_index": ("SELECT tag, 'ls' AS kind, rank, theme_id AS item, NULL::DOUBLE AS weight FROM ls "
                      "UNION ALL SELECT tag, 'tg', rank, sim_tag, weight FROM tg"),
        "profile_recall": "SELECT * FROM precall",
        "profile_extend": "SELECT user_id, tag, round(weight, 12) AS weight FROM f0",
        "profile_expand": "SELECT * FROM expanded",
        "profile_lists": "SELECT * FROM lists",
        "serving_merge": "SELECT * FROM merged",
        "serving_cells": "SELECT * FROM cells",
        "sorted_export": ("SELECT part_id, row_number() OVER (PARTITION BY part_id ORDER BY rowkey, family, qualifier) - 1 AS pos, "
                          "rowkey, family, qualifier, value FROM export"),
        "als_ids": ("SELECT 'user' AS kind, user_id AS key, \"user\" AS id FROM uid "
                    "UNION ALL SELECT 'item', theme_id, item FROM iid"),
        "als_ratings": "SELECT * FROM ratings",
        "als_user_factors": f"SELECT \"user\" AS id, {p.als_rank}::BIGINT AS n_features, true AS finite FROM uid",
        "als_item_factors": f"SELECT item AS id, {p.als_rank}::BIGINT AS n_features, true AS finite FROM iid",
        "als_normal_equations": "SELECT DISTINCT \"user\" AS id, true AS solved FROM ratings",
        "als_predictions": "SELECT \"user\", item, rating, true AS is_dot FROM ratings",
        "als_mse": "SELECT count(*) AS n, true AS same FROM ratings",
        "split_limit": ("SELECT line, split_part(line, '::', 1) AS head, CASE WHEN strpos(line, '::') = 0 THEN NULL "
                        "ELSE substr(line, strpos(line, '::') + 2) END AS rest, "
                        "(CASE WHEN strpos(line, '::') = 0 THEN 1 ELSE 2 END)::BIGINT AS n_parts FROM ("
                        "SELECT concat_ws('::', CAST(p_partkey AS VARCHAR), p_name, p_type, p_brand) AS line FROM part)"),
    }


def _age_sql(p: Params) -> str:
    ts = "try_strptime(time, '%Y-%m-%d %H:%M:%S')"
    return (f"(CASE WHEN {ts} IS NULL THEN {p.days_profile}::BIGINT "
            f"ELSE ({epoch_seconds(p.as_of)}::BIGINT - epoch({ts})::BIGINT) // 86400 END)")


_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _deps(text: str, names) -> list[str]:
    words = set(_WORD.findall(text))
    return [n for n in names if n in words]


def sql(name: str, p: Params = DEFAULT) -> str:
    defs = _defs(p)
    final = _finals(p)[name]
    order: list[str] = []

    def visit(n, stack=()):
        if n in order or n in stack:
            return
        for dep in _deps(defs[n], defs):
            if dep != n:
                visit(dep, stack + (n,))
        order.append(n)

    for dep in _deps(final, defs):
        visit(dep)
    if not order:
        return final
    ctes = ",\n".join(f"{n} AS ({defs[n]})" for n in order)
    return f"WITH {'RECURSIVE ' if 'fr' in order else ''}{ctes}\n{final}"


def oracle_sql(p: Params = DEFAULT) -> dict[str, str]:
    return {n: sql(n, p) for n in _finals(p)}
