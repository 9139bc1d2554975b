"""Schemas of inputs, generated records and the evaluation tables."""

from __future__ import annotations

from corpuskit.functions.chat import MESSAGES, ROW

CHAT = f"messages {MESSAGES}, is_mcq boolean, meta struct<source:string,source_config:string,split:string>"
ENVELOPE = f"source string, source_config string, split string, row {ROW}"
BENCHMARK = "benchmark string, text string, raw_question string, config_name string, index bigint"
GENERATED = f"source string, type string, topic string, difficulty string, question string, options map<string,string>, answer string, messages {MESSAGES}, raw_prompt string, raw_response string"

#: The relational catalogue: table -> columns. JSON documents are variants.
TABLES = {
    "eval_models": "id int, name string, provider string, created_at timestamp",
    "eval_datasets": "id int, name string, split string, created_at timestamp",
    "eval_runs": "id int, model_id int, dataset_id int, judge_model string, config_json variant, started_at timestamp, finished_at timestamp, status string, error_message string, candidate_model string, model_name string, task_name string, config variant, completed_at timestamp_ntz, total_samples int, metrics variant, is_thinking_model boolean, thinking_stats variant",
    "eval_samples": "id int, run_id int, sample_index int, source string, category string, subcategory string, format string, instruction string, reference string, prediction string, judge_score decimal(38,18), judge_reason string, judge_raw variant, meta variant, created_at timestamp, raw_prompt string, raw_response string, thinking_content string, thinking_tokens int, answer_tokens int, latency_ms decimal(38,18), extraction_method string, extraction_confidence decimal(38,18)",
    "eval_job_requests": "id bigint, dataset_name string, dataset_configs array<string>, split string, model_name string, judge_model string, max_workers int, max_tokens int, status string, created_at timestamp, started_at timestamp, finished_at timestamp, last_error string, runs variant, config_json variant, error_message string",
    "alghafa_eval_samples": "id bigint, run_id int, model_idf string, category string, category_idx int, sub_category string, expected_answer int, question string, option_texts array<string>, response_raw string, reasoning string, predicted_answer int, arabic_percentage double, created_at timestamp_ntz",
    "alghafa_audit_results": "id bigint, primary_category string, secondary_category string, model_reasoning_assessment string, benchmark_expected_answer_is_correct string, predicted_option_is_correct string, failure_attribution string, created_at timestamp, eval_model_name string",
    "alrage_analysis": "index_id int, question string, gold_answer string, candidates string, reasoning_types array<string>, context_structure string, answer_position string, is_answerable boolean, has_noise boolean, noise_level string, analysis_trace string, created_at timestamp",
    "question_recipes": "recipe_id int, source_sheet string, grade_level string, subject string, domain string, cluster string, standard_id_l1 string, standard_desc_l1 string, standard_id_l2 string, standard_desc_l2 string, substandard_id string, lesson_title string, question_type array<string>, tasks string, difficulty string, constraints string, direct_instruction string, step_by_step_explanation string, misconception_1 string, misconception_2 string, misconception_3 string, misconception_4 string, created_at timestamp, misconceptions string, refined_difficulty variant",
    "generated_questions": "id int, recipe_id int, model string, inference_params variant, prompt_text string, model_raw_response string, model_parsed_response variant, created_at timestamp_ntz, question_type string, experiment_tracker string, embedding array<float>, embedding_model string, image_uri string, image_url string, image_prompt string, updated_at timestamp_ntz",
    "ai_evaluation_results": "id int, question_id int, evaluator_version string, evaluator_raw_response string, evaluator_parsed_response variant, evaluator_score double, evaluated_at timestamp, evaluator_tracker string, evaluator_input variant",
    "question_image_requirements": "q_id bigint, need_image boolean",
    "image_generations_test": "question_id bigint, requires_image boolean, image_gen_prompt_builder_prompt string, image_gen_prompt string, image_gen_model string, image_s3_uri string, created_at timestamp_ntz, nanobanana_image_s3_uri string, is_svg boolean, evaluator_tracker string, svg_code string",
    "mcq_qas": "id int, source_dataset string, question_type string, listed_grade int, listed_grade_level string, listed_difficulty double, estimated_grade int, estimated_grade_level string, estimated_difficulty double, question string, option_a string, option_b string, option_c string, option_d string, correct_answer string, explanation string, created_at timestamp_ntz, option_e string, option_f string, option_g string, estimated_subject string, context string",
    "open_ended_qas": "id int, source_dataset string, question_type string, listed_grade int, listed_grade_level string, listed_difficulty double, estimated_grade int, estimated_grade_level string, estimated_difficulty string, estimated_subject string, listed_subject string, question string, correct_answer string, explanation string, context string, created_at timestamp_ntz",
    "book_chapters": "id int, chapter_id string, book_id string, book_title string, chapter_order int, chapter_title string, subject string, estimated_grade int, estimated_grade_level string, estimated_difficulty string, word_count int, char_count int, text string, meta variant, created_at timestamp_ntz",
    "api_tokens": "id int, token string, client_name string, is_active boolean, created_at timestamp_ntz, app_name string",
    "incept_api_logs": "id int, request_timestamp timestamp_ntz, source_ip string, user_agent string, method string, url string, request_body string, response_body string, status_code int, process_time_seconds double, client_name string, prompt string",
    "leaderboard_results": "model string, subject string, question_type string, difficulty string, questions_above_threshold bigint, total_questions bigint, difficulty_sort_key int",
}
TABLES["alrage_train_dataset_analysis"] = TABLES["alrage_analysis"]
