"""Input relations of the registered queries, derived from the driver's tables by SQL that both engines read.

The tables hold invented words, so papers, model outputs, open-access locations and file names are
spelt from their columns: every branch of the operators occurs, at any size of the tables.
"""

from __future__ import annotations

_N, _S = "CAST(p_partkey AS STRING)", "CAST(p_size AS STRING)"

#: row_ord, corpus_id, doi, abstract, authors, year, article_url
PAPERS = f"""SELECT p_partkey AS row_ord, 'c' || {_N} AS corpus_id, '10.5/' || {_N} AS doi,
 CASE WHEN p_partkey % 31 = 30 THEN NULL ELSE trim(
 CASE p_partkey % 4 WHEN 0 THEN 'Background: the ' || p_name || ' was assessed in a randomized trial of long duration across several sites. '
 WHEN 1 THEN 'Methods included a survey of ' || {_S} || ' sites where the ' || p_name || ' was in use for the whole period. '
 WHEN 2 THEN 'We surveyed ' || p_name || ' users in all regions of the country over a long period of time. We conducted interviews in each of the regions, and visits followed after that. ' ELSE '' END
 || CASE p_partkey % 3 WHEN 0 THEN 'The ' || p_name || ' may suggest a limited benefit of ' || {_S} || '% in treated groups, which is unclear. '
 WHEN 1 THEN 'Effects of the ' || p_name || ' could possibly appear , in the later follow-up of the treated groups. ' ELSE '' END
 || CASE p_partkey % 10 WHEN 0 THEN 'Results showed that the rate increased by ' || {_S} || '% in the treated group. '
 WHEN 1 THEN 'Sensitivity was ' || {_S} || '.5% for the ' || p_name || ' in all of the groups tested here. '
 WHEN 2 THEN 'The trial enrolled 1,2' || lpad({_S}, 2, '0') || ' participants at all the sites of the network. '
 WHEN 3 THEN 'Efficacy against COVID-19 was ' || {_S} || '% in the ' || p_name || ' group of the trial. '
 WHEN 4 THEN 'A total of ' || {_S} || '% of patients responded to the ' || p_name || ' during the trial. '
 WHEN 5 THEN 'Patients were followed for a mean of ' || {_S} || ' months after the first visit to a site. '
 WHEN 6 THEN 'The model reached an AUC of 0.' || lpad({_S}, 2, '0') || ' when it was tested on the ' || p_name || ' data. '
 WHEN 7 THEN 'The rate was ' || {_S} || '% (95% CI 2-90) at the end of the study period in 2004. '
 WHEN 8 THEN 'In all, ' || {_S} || ' of 90 participants showed a response to the ' || p_name || ' at the end. '
 ELSE 'Vaccine efficacy of ' || {_S} || '% was seen in n = ' || CAST(p_size + 20 AS STRING) || ' adults in the second year. ' END
 || CASE p_partkey % 7 WHEN 0 THEN 'Protocol compliance was high, as was found in all of the groups during the whole study period. '
 WHEN 1 THEN 'It was found that rates did not differ between treated and control groups at the end of the follow-up. '
 WHEN 2 THEN 'A significant association was observed between ' || p_name || ' use and early recovery, as found in all groups. '
 WHEN 3 THEN 'It was found that treatment was associated with improved recovery of patients, in all of the groups. '
 WHEN 4 THEN 'Scores decreased significantly in the ' || p_name || ' arm, and this was found at all of the sites. '
 WHEN 5 THEN 'Markers were significantly elevated in the ' || p_name || ' group, as the results of the tests show. ' ELSE '' END
 || CASE p_partkey % 5 WHEN 0 THEN 'Adverse events were much the same in both groups, with ' || {_S} || ' events in all of the sites taken together.'
 WHEN 1 THEN 'About ' || CAST(p_size + 3 AS STRING) || '% power was reached by the end of the second year of the study.' ELSE '' END) END AS abstract,
 split(CASE p_size % 5 WHEN 0 THEN 'Ann Lee' WHEN 1 THEN 'Ann Lee;Kim, Bo' WHEN 2 THEN 'van Dyk, Cy;Bo Kim;Ann Lee' WHEN 3 THEN '' ELSE 'Bo Kim;Ann van Lee' END, ';') AS authors,
 CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 6 = 1 THEN 0 ELSE CAST(1995 + p_partkey % 30 AS INT) END AS year,
 CASE WHEN p_partkey % 2 = 0 THEN 'https://ex.org/' || {_N} END AS article_url FROM {{part}}"""

_SAID = f"'The ' || p_name || ' rate was ' || {_S} || '% in all.'"
_QUOTE = f"'rate was ' || {_S} || '%'"
_CLAIM = f"""'{{{{"claim": "It was ' || {_S} || '%", "verdict": "' || CASE p_size % 5 WHEN 0 THEN 'supported' WHEN 1 THEN 'weak' WHEN 2 THEN 'contradicted' WHEN 3 THEN 'not_in_source' ELSE 'supported' END || '", "sourceQuotes": ["' || CASE WHEN p_size % 3 = 0 THEN 'no such words' ELSE {_QUOTE} END || '"]}}}}'"""

#: row_ord, id, source_excerpt, category, min_claims, want, ban, allow (comma-joined or null), quotes
EVALS = f"""SELECT p_partkey AS row_ord, CASE WHEN p_partkey < 90 THEN 'h-' || lpad(CAST(p_partkey + 1 AS STRING), 3, '0') ELSE 'x-' || {_N} END AS id, {_SAID} AS source_excerpt,
 CASE WHEN p_partkey % 9 = 8 THEN 'own' WHEN p_partkey >= 90 AND p_partkey % 9 = 7 THEN 'legacy' END AS category, CASE WHEN p_partkey % 4 = 0 THEN 2 ELSE 1 END AS min_claims,
 CASE WHEN p_partkey % 3 = 0 THEN 'supported,weak' END AS want, CASE WHEN p_partkey % 5 = 1 THEN 'supported' WHEN p_partkey % 5 = 2 THEN 'weak,contradicted' END AS ban,
 CASE WHEN p_partkey % 7 = 3 THEN 'supported,weak,not_in_source' END AS allow, p_partkey % 2 = 0 AS quotes FROM {{part}}"""

#: id, raw_output, seconds; every eleventh evaluation row has none
OUTPUTS = f"""SELECT CASE WHEN p_partkey < 90 THEN 'h-' || lpad(CAST(p_partkey + 1 AS STRING), 3, '0') ELSE 'x-' || {_N} END AS id, p_partkey AS row_ord, CAST(p_size % 8 AS DOUBLE) / 4 AS seconds, p_name AS name,
 CASE p_partkey % 13 WHEN 0 THEN '{{{{"claims": [' || {_CLAIM} || ']}}}}'
 WHEN 1 THEN '```json' || chr(10) || '{{{{"claims": [' || {_CLAIM} || ', {{{{"claim": "more", "verdict": "weak", "sourceQuotes": []}}}}]}}}}' || chr(10) || '```'
 WHEN 2 THEN '{{{{"claims": [' || {_CLAIM} || ',], }}}}'
 WHEN 3 THEN '<channel|> {{{{"claims": [' || {_CLAIM} || ', {{{{"claim": " ", "verdict": "weak"}}}}]}}}}'
 WHEN 4 THEN 'No object at all.'
 WHEN 5 THEN '{{{{"claims": 3}}}}'
 WHEN 6 THEN 'Here it is: {{{{"claims": [' || {_CLAIM} || ', {{{{"claim": "x", "verdict": "maybe"}}}}]}}}} as asked'
 WHEN 7 THEN '{{{{"claims": [' || {_CLAIM} || '}}}}'
 WHEN 8 THEN '{{{{"claims"?: [' || {_CLAIM} || '],}}}}'
 WHEN 9 THEN '{{{{"claims": []}}}}'
 WHEN 10 THEN ''
 WHEN 11 THEN '{{{{"claims": [' || {_CLAIM} || ', ' || {_CLAIM} || '], "overallVerdict": "support"}}}}'
 ELSE '{{{{"claims": [{{{{"claim": "only", "verdict": "supported", "sourceQuotes": ["' || {_QUOTE} || '"]}}}}], "notes": "n"}}}}' END AS raw_output FROM {{part}} WHERE p_partkey % 11 <> 10"""

_C = "CAST(c_custkey AS STRING)"
#: doi, pos, url_for_pdf, url, landing, host_type: five locations a DOI, some of them the same
LOCATIONS = f"""SELECT CASE WHEN c_custkey % 4 = 0 THEN 'https://doi.org/10.7/Ab(' WHEN c_custkey % 4 = 1 THEN 'DOI:10.7/ab(' ELSE '10.7/AB(' END || CAST(c_custkey % 30 AS STRING) || ')' AS doi, c_custkey AS pos,
 CASE WHEN c_custkey % 3 = 0 THEN ' https://repo.example.org/pdf/10.7%2Fab(' || CAST(c_custkey % 30 AS STRING) || ').pdf ' WHEN c_custkey % 3 = 1 THEN '' END AS url_for_pdf,
 CASE c_custkey % 7 WHEN 0 THEN 'https://arxiv.org/abs/' || CAST(c_custkey % 60 AS STRING) WHEN 1 THEN 'https://www.ncbi.nlm.nih.gov/pmc/articles/PMC' || CAST(100 + c_custkey % 40 AS STRING) || '/'
 WHEN 2 THEN 'https://doi.org/10.7/ab(' || CAST(c_custkey % 30 AS STRING) || ')' WHEN 3 THEN 'https://hdl.handle.net/' || {_C} WHEN 4 THEN 'https://pub.example.com/x.pdf' WHEN 5 THEN NULL ELSE 'https://ine.es/' || {_C} END AS url,
 CASE WHEN c_custkey % 2 = 0 THEN 'https://land.example.net/' || {_C} END AS landing, CASE c_custkey % 4 WHEN 0 THEN 'repository' WHEN 1 THEN 'Publisher' WHEN 2 THEN 'repository' END AS host_type,
 'Title ' || {_C} AS title, CASE WHEN c_custkey % 17 = 0 THEN 'operator_override' ELSE 'scored' END AS selection, c_custkey AS line FROM {{customer}}"""

#: name, size, sha256, file_line, file_doi of PDF files
FILES = """SELECT lpad(CAST(o_orderkey % 500 AS STRING), 3, '0') || '_10.5_' || CAST(o_orderkey % 300 AS STRING) || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'b' END || '.pdf' AS name, o_orderkey AS size, md5(CAST(o_custkey AS STRING)) AS sha256,
 o_orderkey % 500 AS file_line, CASE WHEN o_orderkey % 3 = 0 THEN '10.5/' || CAST(o_orderkey % 300 AS STRING) END AS file_doi FROM {orders}"""
