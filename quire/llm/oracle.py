"""SQL for those queries that SQL can express; each runs over the same whole tables."""

from __future__ import annotations

from quire.llm.copies import ARTICLES

_ARTICLES = ", ".join(f"'{a}'" for a in dict.fromkeys(ARTICLES))

# Entries: the pieces of collection, article and word between punctuation and white space.
_ENTRIES = rf"""
with pieces as (
  select vocab_id,
         list_filter(regexp_split_to_array(replace(lower(coalesce(collection, '')), 'ß', 'ss'), '[\p{{P}}\p{{Z}}\s\x0b]+'), lambda t: t <> '') as c,
         list_filter(regexp_split_to_array(replace(lower(coalesce(article, '')), 'ß', 'ss'), '[\p{{P}}\p{{Z}}\s\x0b]+'), lambda t: t <> '') as a,
         list_filter(regexp_split_to_array(replace(lower(coalesce(word, '')), 'ß', 'ss'), '[\p{{P}}\p{{Z}}\s\x0b]+'), lambda t: t <> '') as w
  from vocabulary
), held as (
  select vocab_id, array_to_string(c, '') as c, a, w,
         case when len(a) = 0 then w when len(w) = 0 then a end as one
  from pieces
), halves as (
  select vocab_id, c,
    case when one is null then array_to_string(a, '')
         when len(one) > 1 and one[1] in ({_ARTICLES}) then one[1]
         when len(one) > 1 and one[-1] in ({_ARTICLES}) then one[-1]
         else '' end as x,
    case when one is null then array_to_string(w, '')
         when len(one) > 1 and one[1] in ({_ARTICLES}) then array_to_string(one[2:], '')
         when len(one) > 1 and one[-1] in ({_ARTICLES}) then array_to_string(one[:-2], '')
         else array_to_string(one, '') end as y
  from held
), keyed as (
  select vocab_id, c || chr(1) || least(x, y) || chr(1) || greatest(x, y) as k from halves
)
"""

# Words of a text: letters and digits, caseless, without accents, tags and invisible characters.
_PASSAGES = r"""
with texts as (
  select 'd' as side, doc_id as id, text from documents where text is not null
  union all select 'b', item_id, text from benchmark where text is not null
), split as (
  select side, id, regexp_extract_all(replace(strip_accents(lower(regexp_replace(regexp_replace(text,
    '</?[A-Za-z][^<>]*>', ' ', 'g'), '\p{Cf}', '', 'g'))), 'ß', 'ss'), '[\p{L}\p{N}]+') as w
  from texts
), grams as (
  select side, id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) as g
  from split where len(w) >= 12
), pairs as (
  select distinct d.id as doc_id, b.id as item_id
  from grams d join grams b on d.g = b.g and d.side = 'd' and b.side = 'b'
)
"""

# Values with an invisible character, another space, a width or ligature form, parts of a composed letter,
# or a word of Latin and other letters.
_LOOKALIKES = r"""
with texts as (
  select 'question' as field_name, question_id as row_id, question as text from questions
  union all select 'word', vocab_id, word from vocabulary
  union all select 'translation', vocab_id, translation from vocabulary
), seen as (
  select *, regexp_replace(text, '\p{Cf}', '', 'g') as shown from texts where text is not null
)
select field_name, row_id from seen
where shown <> text or nfc_normalize(shown) <> shown
   or regexp_matches(text, '[\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]')
   or regexp_matches(text, '[\x{ff01}-\x{ffee}\x{fb00}-\x{fb06}\x{0132}\x{0133}]')
   or regexp_matches(shown, '\p{Latin}\p{M}*[\p{Greek}\p{Cyrillic}]|[\p{Greek}\p{Cyrillic}]\p{M}*\p{Latin}')
"""

ORACLE: dict[str, str] = {
    "p4_found": _ENTRIES + "select f.first_id, v.vocab_id as copy_id from keyed v join (select k, min(vocab_id) as first_id from keyed group by k) f on f.k = v.k where v.vocab_id <> f.first_id",
    "p4_entries": _ENTRIES
    + """select min(keyed.vocab_id) as first_id, count(*) as copies,
      count(distinct coalesce(v.collection, chr(2)) || chr(1) || coalesce(v.article, chr(2)) || chr(1) || coalesce(v.word, chr(2))) as spellings
      from keyed join vocabulary v on v.vocab_id = keyed.vocab_id group by k""",
    "p5_found": _LOOKALIKES,
    "p8_found": _PASSAGES + "select doc_id, item_id from pairs",
    "p8_items": _PASSAGES + "select item_id, count(*) as documents from pairs group by item_id",
}
