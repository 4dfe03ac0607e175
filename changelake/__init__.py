"""changelake: change capture, change-file shipping and replica replay as Spark jobs."""
