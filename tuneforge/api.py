"""The public operators in one place: ``from tuneforge.api import exact_split, mix_in, ...``."""

from .flows import make_dataset, multihop_dataset, prompt_results, read_dataset, sft_dataset, sheet_source, split_examples
from .functions.json_valid import json_valid
from .functions.keys import row_key, shuffle_hash
from .functions.prompts import (PromptBuilder, context_qa_prompt, extractive_prompt, flatten_context, flatten_context_pairs, joint_text,
                                multi_source_prompt, own_qa_prompt)
from .functions.text import contains_any, is_snapshot, py_strip, result_time, strip_echo
from .functions.tokenizer import byte_level_tokenizer_json, tokenise, tokenizer_ids
from .functions.tokens import (append_eos, codepoint_ids, encode_fixed, encode_segment, label_after_prompt, label_all,
                               label_answer_only, label_joint, n_supervised, non_pad_count, pad_or_eos, truncate_right)
from .operators.batches import pad_batches
from .operators.dialogue import first_utterance, pair_turns, renumber_after_leading
from .operators.mix import exclude_sampled, mix_in
from .operators.recipes import apply_recipes, each_recipe, recipe_cut, recipe_grid, recipe_list, recipe_sizes, recipe_thresholds
from .operators.records import (as_records, concat, dispatch_kind, drop_if_present, fill_missing, keep_only,
                                merge_sources)
from .operators.reports import count_report, observed_count, size_of, split_report
from .operators.score import result_rows, score
from .operators.sft import sft_encode
from .operators.sheets import drop_unmapped_sheets, read_sheet_table, resolve_columns, sheet_records, until_first_blank
from .operators.split import (bounded_head, exact_split, holdout, positional_split, require_enough, sample_exact,
                              seeded_shuffle, take_capped)
from .session import ensure_checkpoint_dir, local_session, materialize
from .sinks.batch_log import append_once, committed_batches, read_log
from .sinks.dialogues import write_dialogues
from .sinks.ordered import read_ordered, write_ordered
from .sinks.writers import (append_results, build_if_absent, dataset_path, latest_by, latest_snapshot, next_run_path,
                            run_path, write_jsonl, write_run, write_splits)
from .sources.cells import cells_from_csv, cells_from_csv_sheets, read_cells, read_workbooks, workbook_cells, workbook_rejects
from .sources.jsonl import (drop_blank_lines, extract_records, filter_valid_json, line_keys, read_dialogues, read_jsonl,
                            read_public_qa, read_split_jsonl)
from .sources.lines import number_lines, scan_lines
from .streaming.score_stream import score_stream

__all__ = [n for n in dir() if not n.startswith("_")]
