"""DataFrame -> DataFrame operators. No action runs inside them except where noted
(bounded-broadcast checks count a side; ALS fitting and grid search need metrics)."""
