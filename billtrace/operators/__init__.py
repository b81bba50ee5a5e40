"""DataFrame operators. None starts a job, keeps state or collects rows, except where it says so."""
