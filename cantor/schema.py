"""The normalised tables. All are keyed by book_id; absence is a missing row, never a placeholder."""

from __future__ import annotations

SOURCE = "struct<kind:string,id:string,url:string>"
SECTION = "struct<position:int,file:string,secs:double,title:string,reader:string>"
PHRASE_ROW = "struct<phrase_index:int,begin_secs:double,confidence:double,section:int>"
WORD_ROW = "struct<begin_secs:double,word:string,confidence:double>"
GATES = "struct<minMedianConf:double,minCoverage:double,minDocCoverage:double,maxLeadS:double,maxEndGap:double>"
VERDICT = f"struct<pass:boolean,docCoverage:double,refusal:string,gates:{GATES}>"
META = (
    "struct<paras:int,placed:int,start_gap:double,end_gap:double,span_coverage:double,lead_s:double,tail_s:double,"
    "phrases:int,median_conf:double,inversions:int,audio_s:int,sections:int,device:string,model:string,language:string>"
)
BOOK = f"struct<title:string,author:string,language:string,source:{SOURCE}>"
TEXT = "struct<file:string,sha256:string,paragraphs:int>"
AUDIO = f"struct<source:{SOURCE},sections:array<{SECTION}>>"
#: Rows of the maps are arrays in the document; words mix text and numbers, so they are read as text and cast.
ALIGNMENT = f"struct<model:string,language:string,alignedAt:string,textSha256:string,phrases:map<string,array<array<double>>>,words:map<string,array<array<string>>>,meta:{META},verdict:{VERDICT}>"
DOCUMENT = f"format string, generator string, book {BOOK}, text {TEXT}, audio {AUDIO}, alignment {ALIGNMENT}"

FRAGMENT = "book_id long, ord int, anchor_id string, text string"
WORD = "book_id long, g long, ord int, phrase int, norm string"
ALIGNED = "book_id long, g long, bf long, ef long, score double"
ANCHOR = "book_id long, seq int, w0 long, f0 long"
EMISSION = "book_id long, section int, chunk int, frames int, logits binary"

#: Feed of a recording, as its source delivers it.
FEED = "books array<struct<title:string,url:string,sections:array<struct<section_number:string,title:string,listen_url:string,readers:array<struct<display_name:string>>>>>>"
