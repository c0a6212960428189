"""``spark-submit submit.py STAGE --root ...``; see ``layerkit.jobs``."""

from layerkit.jobs import main

if __name__ == "__main__":
    main()
