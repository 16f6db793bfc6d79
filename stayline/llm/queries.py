"""One query per operator, each over its whole table, and the SQL that some are checked against."""

from __future__ import annotations

from stayline.llm import decontaminate, line_dedup, merkle, minhash, rendezvous, warc
from stayline.llm.decontaminate import op10_decontaminate
from stayline.llm.direct_codes import op4_direct_codes
from stayline.llm.language_mix import op7_language_mix
from stayline.llm.line_crf import op1_line_crf
from stayline.llm.line_dedup import op2_line_dedup
from stayline.llm.merkle import op13_merkle
from stayline.llm.minhash import op11_minhash
from stayline.llm.ngram_trie import op9_ngram_trie
from stayline.llm.packing import op6_pack_genetic
from stayline.llm.rendezvous import op5_rendezvous
from stayline.llm.simhash import op8_simhash
from stayline.llm.warc import op3_warc_revisits
from stayline.llm.whitening import op12_whitening

QUERIES = {
    "op1_line_crf": op1_line_crf,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc_revisits": op3_warc_revisits,
    "op4_direct_codes": op4_direct_codes,
    "op5_rendezvous": op5_rendezvous,
    "op6_pack_genetic": op6_pack_genetic,
    "op7_language_mix": op7_language_mix,
    "op8_simhash": op8_simhash,
    "op9_ngram_trie": op9_ngram_trie,
    "op10_decontaminate": op10_decontaminate,
    "op11_minhash": op11_minhash,
    "op12_whitening": op12_whitening,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op3_warc_revisits": warc.ORACLE,
    "op5_rendezvous": rendezvous.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_minhash": minhash.ORACLE,
    "op13_merkle": merkle.ORACLE,
}
