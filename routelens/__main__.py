from routelens.streaming.job import run_job

run_job()
